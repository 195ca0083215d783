"""Values that must be as they are for results to be right: patterns, word lists, maps and texts of prompts."""

# Whitespace as Python's str.split and str.strip understand it, for Java's regex engine.
WS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"

# Remains of web pages in a chunk; two different ones make it boilerplate.
BOILERPLATE = [
    r"\bcookies?\b.{0,40}\baccept\b",
    r"\bprivacy policy\b",
    r"\bterms of (service|use)\b",
    r"\ball rights reserved\b",
    r"\bcopyright \d{4}\b",
    r"\bsubscribe (now|today|to)\b",
    r"\bnewsletter\b",
    r"\bclick here\b",
    r"\badvertisement\b",
    r"\bsponsored (by|content)\b",
    r"\bskip (to|the) (main |navigation|content)\b",
    r"\blog in\b.{0,20}\bsign up\b",
    r"\bsign (in|up) (to|for)\b",
    r"\bshare (this|on)\b",
    r"\bdisqus\b",
    r"\bjavascript (is |must be )(enabled|required)\b",
]
BOILERPLATE_LEAST = 2

# Garbage of scrapers; one makes a sample bad.
BAD_SAMPLE = [
    r"just a moment",
    r"enable javascript",
    r"checking your browser",
    r"ddos protection by cloudflare",
    r"ray id:",
    r"<html",
    r"window\.__",
    r"document\.cookie",
    r"function\s*\(",
    r"subscribe (now|today)",
    r"click here to",
    r"\bnewsletter\b.{0,30}\bsign up\b",
    r"all rights reserved",
]

# Categories by task.
STORY_CATEGORIES = ["webnovel", "extra_lore", "fan_creation", "trpg", "trpg_extra"]
TRANSLATION_CATEGORIES = ["multilingual_lore"]
LITERATURE_CATEGORY = "webnovel"

# Labels of tags for instructions, then for conversations; the first known tag of a source counts.
GENRES = {
    "litrpg": "LitRPG",
    "progression": "Progression Fantasy",
    "isekai": "Isekai fantasy",
    "fantasy": "epic fantasy",
    "fanfic": "fan fiction",
    "original": "original fantasy",
    "ja": "Japanese light novel",
    "en": "English web novel",
    "horror": "dark horror",
    "scifi": "science fiction",
    "cyberpunk": "cyberpunk",
}
GENRE_DEFAULT = "fantasy"
STORY_GENRES = {
    "litrpg": "LitRPG",
    "progression": "Progression Fantasy",
    "isekai": "Isekai 異世界",
    "fantasy": "奇幻 (Fantasy)",
    "fanfic": "Fan Fiction",
    "original": "Original Fantasy",
    "ja": "日式輕小說 (Light Novel)",
    "en": "English Web Fiction",
    "horror": "Dark Horror",
    "scifi": "Science Fiction",
    "cyberpunk": "Cyberpunk",
}
STORY_GENRE_DEFAULT = "奇幻 (Fantasy)"
SYSTEM_NAMES = {
    "Pathfinder": "Pathfinder",
    "Warhammer Fantasy": "Warhammer Fantasy Roleplay",
    "Warhammer 40,000": "Warhammer 40,000",
    "Shadowrun": "Shadowrun",
    "World of Darkness": "World of Darkness",
    "Call of Cthulhu": "Call of Cthulhu",
    "Iron Kingdoms": "Iron Kingdoms",
    "Blades in the Dark": "Blades in the Dark",
    "Legend of the Five Rings": "Legend of the Five Rings",
    "Deadlands": "Deadlands",
    "Mutant: Year Zero": "Mutant: Year Zero",
    "Gloomhaven": "Gloomhaven",
    "Lexicanum (Warhammer)": "Warhammer",
}
LANGUAGE_NAMES = {
    "zh": "繁體中文 (Traditional Chinese)",
    "ja": "日語 (Japanese)",
    "es": "西班牙語 (Spanish)",
    "fr": "法語 (French)",
    "en": "英語 (English)",
}

# Prompts.
RPG_PROMPTS = [
    "You are a Game Master for a {system} campaign. Describe the following location or faction to the players in vivid, atmospheric prose: {topic}",
    "As a narrator for {system}, write a lore entry about: {topic}",
    "Create a GM handout for players about the following {system} worldbuilding element: {topic}",
    "Write a world almanac entry in the style of {system} about: {topic}",
    "You are writing flavor text for a {system} sourcebook. The subject is: {topic}",
    "A scholar in the world of {system} writes in their journal about: {topic}",
    "Describe the history and significance of the following {system} concept for new players: {topic}",
    "Write an in-world document from the universe of {system} about: {topic}",
    "As the narrator of a {system} adventure, set the scene for: {topic}",
    "Provide a detailed lore description suitable for a {system} campaign sourcebook about: {topic}",
]
LITERATURE_PROMPTS = [
    "Write a passage in the style of {genre} web fiction. Continue or respond to the following creative writing prompt: {derived_prompt}",
    "You are writing a {genre} story. Continue the narrative: {derived_prompt}",
    "In the {genre} genre, write a scene that develops from: {derived_prompt}",
    "As a {genre} author, write the next passage given this setup: {derived_prompt}",
    "Complete this {genre} story excerpt with vivid detail: {derived_prompt}",
    "Write the next chapter segment for a {genre} story that begins: {derived_prompt}",
    "Continue this {genre} narrative in an engaging style: {derived_prompt}",
    "Expand upon the following {genre} story beat into a full prose passage: {derived_prompt}",
]
CONTINUATION_PROMPTS = [
    "Continue the story from where it left off:",
    "The next passage begins here:",
    "Continue this narrative:",
    "Write the continuation of the following excerpt:",
    "What happens next in the story?",
]
CONTINUATION_PROMPTS_JA = [
    "次の文章を続けてください：",
    "物語の続きを書いてください：",
    "この場面の続きを記してください：",
]
TRANSLATE_TO_EN = [
    "將以下文本翻譯成流暢的英語，保留奇幻風格與專有名詞：",
    "請把以下段落翻譯成英文，維持原有的世界觀語氣：",
]
TRANSLATE_FROM_EN = [
    "請將以下英語文本翻譯成{lang}，保留奇幻風格：",
    "把以下英語段落翻譯成{lang}，維持世界觀風格：",
]
# System prompts of conversations.
STORY_SYSTEM = "You are a creative narrative writer specializing in {genre} fiction. Given a story excerpt or opening line, continue the narrative with vivid prose that matches the existing tone and style."
STORY_SYSTEM_JA = "あなたは{genre}の熟練した物語作家です。与えられた文章や書き出しに続けて、既存のトーンやスタイルに合わせた生き生きとした散文で物語を続けてください。"
NER_SYSTEM = '你是一個遊戲後台的實體抓取器 (NER)。請分析以下文本，精準提取所有角色名稱與組織名稱，並以 JSON 格式輸出。輸出格式：{"角色": ["..."], "組織": ["..."]}'
SENTIMENT_SYSTEM = "你是一個情緒判讀分析器。請閱讀以下文本段落，判斷其主要情緒基調，並從下列標籤中選擇最符合者輸出：「正面 (Positive)」、「負面/緊張 (Negative/Tense)」、「中性/描述 (Neutral)」、「動作/衝突 (Action)」。只需輸出標籤名稱，不需額外說明。"
TRANSLATOR_SYSTEM = "你是一個精通多語言的遊戲世界觀翻譯專家。請將以下{src_lang}的奇幻/遊戲世界觀文本翻譯成{tgt_lang}，保留專有名詞的原始風格與語氣。"
#: What the system prompt of a sentiment record says, and the lists of an entity record one of which must not be empty.
SENTIMENT_MARKS, ENTITY_LISTS = ["情緒判讀", "情緒基調"], ["角色", "組織"]
PENDING = "<NEEDS_GM_RESPONSE>"
GM_SYSTEM = (
    "你是一位資深的遊戲主持人 (Game Master)。"
    "請以充滿戲劇張力的敘事風格回應玩家的行動，"
    "強調場景氛圍、NPC 情感反應，以及選擇帶來的後果。"
    "描述應簡潔有力，突顯玩家決策的重量，避免百科式陳述。"
)

# Words a topic leaves out.
TOPIC_STOP = ["the", "a", "an", "in", "on", "at", "during", "within"]

# Sentiment lexicons and labels.
POSITIVE = "joy triumph victory hope laugh smile happy celebrate cheer brave courage glory honour peace love warm light bright radiant".split()
NEGATIVE = "fear dread despair shadow dark death blood pain agony grief sorrow weep cry horror terror hate anger rage corrupt evil doom".split()
ACTION = "battle fight attack strike charge clash rush dash leap dodge slash thrust parry ambush siege combat war duel chase flee explode".split()
SENTIMENTS = {
    "action": "動作/衝突 (Action)",
    "negative": "負面/緊張 (Negative/Tense)",
    "positive": "正面 (Positive)",
    "neutral": "中性/描述 (Neutral)",
}

# Words that are never part of a name.
NOT_NAMES = """
The A An In On At But And Or Nor So For Yet With By From To Of As Up Out After Before During When While Although However
Into Onto Upon About Against Between Through Over Under Around Within Without Beyond Across
He She It They We You I His Her Their Its Our My Your Him Them Us Me Himself Herself Themselves Itself Yourself
This That These Those There Here Now Then What Which Who Whom Where How Why
Also Both Each Every All Some Any No More Most Much Many Few Little Other Another Same Such Even Only Just Still Already
Very Quite Rather Almost Often Never Always
Chapter Book Part Volume Section Episode Campaign Season Series Story Saga Arc Act Scene Page Line
Age Era Year Years Day Days Night Nights Time Times Hour Hours Week Month Century
World Land Lands City Town Village Kingdom Empire Realm Region Area Place Point North South East West Central
New Old Great Grand Ancient Dark Light High Low Long Short Far Near Deep True First Last Next Previous
Several Various Certain Entire
""".split()
NUMBER_WORDS = """
One Two Three Four Five Six Seven Eight Nine Ten Eleven Twelve Thirteen Fourteen Fifteen Twenty Thirty Hundred Thousand
First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Once Twice
""".split()
ORGANISATIONS = """
guild order clan company empire kingdom republic federation legion brotherhood sisterhood council court house alliance
association academy institute college corps squad regiment brigade army navy fleet bureau ministry department church
temple cult sect faction tribe band party group
""".split()
BARE_ORGANISATIONS = "Guild Order Clan Empire Kingdom Legion Brotherhood Council Alliance Academy Corps Bureau Church Temple Cult Faction Tribe".split()
LORE_FACTIONS = "Order Guild Legion Brotherhood Council Alliance Empire Kingdom".split()

# Strings that are no entities.
NO_ENTITY = """
age era campaign chapter arc season city town world land region area place point empire kingdom realm guild order court
council temple cult north south east west central a an the
""".split() + ["critical role", "crit recap", "exandria unlimited"]

# Keys of reasoning answers and their one spelling.
REASONING_KEYS = {"好感度變化": "好感度增量", "NPC特殊回應": "NPC回應", "NPC態度": "NPC回應"}

# Limits of a healthy dataset.
HEALTH = {
    "bad_rate_warn": 0.03,
    "bad_rate_danger": 0.10,
    "dup_rate_warn": 0.05,
    "dup_rate_danger": 0.20,
    "min_records": 50,
    "min_word_median": 20,
}
HEALTH_BY_FILE = {"lora_analyst.jsonl": {"min_word_median": 3}, "lora_analyst_cleaned.jsonl": {"min_word_median": 3}}
STATUS = {"waiting": "⏳ 待生成", "empty": "✗ 空檔", "danger": "✗ 危險", "warn": "⚠ 警告", "healthy": "✓ 健康"}
DATASET_TYPES = ["lora_storyteller", "lora_analyst", "lora_translator", "lora_reasoning", "rpg_dataset", "literature_dataset"]
