"""Problem 1: unfilled templates, filler, error pages and demands for scripts."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import source_key, take
from .text import fold, h64

# Shapes of template slots that nobody filled.
SLOTS = re.compile(
    r"\{\{[^{}\n]{0,80}\}\}|<<[A-Za-z_ ]{1,40}>>|\{\{\{[^{}\n]{0,40}\}\}|\{%[^%\n]{1,80}%\}|<%[^%\n]{1,80}%>|\$\{[^{}\n]{1,60}\}|#\{[^{}\n]{1,60}\}"
    r"|\{[^\W\d][^{}\n:\"',]{0,40}\}|\{\d{1,2}\}|<\?=?[^<>\n]{1,60}\?>|\$[A-Z][A-Z_]+\$|\[\$?[A-Z]+_[A-Z_]+\]|\[%[^%\n]{1,40}%\]"
    r"|%\([A-Za-z_]\w*\)[sd]|%[A-Z][A-Z_]{2,}%|(?<![\w%])%[sd](?!\w)"
    r"|@@\w{2,}@@|__[A-Z][A-Z_]+__|<[A-Z]+_[A-Z_]+>"
    r"|<(?:insert|add|enter|your|fill|todo|placeholder|por completar|completar|insertar|insérer|ajouter|à compléter|einfügen|hier)\b[^<>\n]{0,60}>"
    r"|\[\[?\s*(?:TBD|TODO|TBA|FIXME|XXX)\b[^\[\]\n]{0,80}\]"
    r"|\[(?:INSERT|ENTER|ADD|YOUR|Your|Insert|Enter|PLACEHOLDER|Placeholder|NAME|NOM|NOMBRE|ORT|LUGAR|LIEU|EINFÜGEN|INSÉRER|INSERTAR|insert|enter|your|add|insérer|ajouter|compléter|insertar|añadir|completar|einfügen|ergänzen|hier)\b[^\[\]\n]{0,60}\]"
    r"|\[[^\[\]\n]{1,80} (?:pending|goes here|to be added|à venir|pendiente|ausstehend)\]"
    r"|\[object Object\]"
    r"|[【〔［\[][^】〕］\]\n]{0,20}(?:入力|記入|ここに|填写|補充|补充|待定|未定|輸入|输入)[^】〕］\]\n]{0,20}[】〕］\]]"
    r"|[○〇×]{3,}"
    r"|\b(?=[A-Z_]*(?:XX|NAME|PLACEHOLDER|TITLE|INSERT))[A-Z]+(?:_[A-Z]+)+\b"
    r"|\[(?:su|tu|votre|ton|ihre?|deine?|your|my|(?:name|title|nom|titre|titel|nombre|título|place|ort|lieu|lugar|date|datum|fecha|author|character|text|texto|texte)(?: of| de| des| du| del| der)?)(?: [^\[\]\n]{1,40})?\](?!\()"
    r"|\[(?:SU|TU|VOTRE|TON|IHRE?|DEINE?|YOUR|NAMEN?|NOM|TITEL|TITRE|TÍTULO|TEXTO?|TEXTE?|Su|Votre|Ihre?|Dein|Name|Title|Nom|Titre|Titel|Nombre|Título|Texto?|Texte)(?: [^\[\]\n]{1,40})?\](?!\()"
    r"|\((?:insert|enter|fill in|insérer|insertar|einfügen|hier)\b[^()\n]{0,60} (?:here|text|description|name|title|ici|aquí|einfügen|eintragen)\b[^()\n]{0,20}\)"
    # where a name should stand, as no article, copula or adverb comes before it
    r"|(?<![\w'’-])(?<!\b[Aa]n )(?<!\b[Tt]he )(?<!\b[Aa] )(?<!\b[Ss]ome )(?<!\b[Aa]ny )(?<!\b[Nn]o )(?<!\bis )(?<!\bare )(?<!\bwas )(?<!\bwere )(?<!\bbe )(?<!\bbeen )(?<!\bleft )(?<!\bremains )(?<!\bremain )(?<!\bas )(?<!\bstill )(?<!\bnot )undefined(?![\w'’-])(?! \w+ly\b)"
    r"|(?<=[぀-ヿ㐀-鿿])undefined(?=[぀-ヿ㐀-鿿])"
)
# What a server, a program or a site says in place of a text; all compared in lower case.
ERRORS = re.compile(
    r"\b[45]\d\d\b[\s\-–—|:,.]{0,4}(?:not found|forbidden|unauthori[sz]ed|bad (?:gateway|request)|gateway time-?out|service (?:temporarily )?unavailable|internal server error|too many requests|gone\b|page|ページ|找不到|页面|nicht gefunden|seite|introuvable|no encontrad)"
    r"|(?:page|file|article|chapter|entry|resource) (?:was |is |could )?(?:not (?:be )?found|no longer available)|requested (?:url|page|resource)"
    r"|may have been (?:moved|deleted|removed)|has been (?:removed|deleted) (?:or|by)|was not found on this server|no text in this page|page (?:does not|doesn't) exist"
    r"|\berror (?:code )?#?\d+\b|\berror:? ?\d{3}|http error|\bfatal error\b|internal (?:server )?error|server error|unexpected error|an error (?:has )?occurred|something went wrong|looks like something"
    r"|access (?:to this (?:page|resource) (?:is|was) |is |was )?(?:denied|forbidden)(?!,)|accessdenied|permission to access|not authori[sz]ed|request blocked|you have been blocked"
    r"|session (?:has |is )?(?:expired|timed out)|(?:log|sign) in again|please (?:log|sign) in to (?:read|view|continue)"
    r"|too many requests|rate limit(?:ed)?|retry after|try again (?:later|in)|(?:connection|request|operation|origin|gateway) (?:to [\w .]{1,40} )?(?:was )?(?:timed out|time-?out|refused|reset)"
    r"|could not connect|database (?:connection|error)|connection failed|sqlstate\[|sql syntax|mysql|postgres|backend fetch|upstream|varnish|cloudflare|\bnginx\b|\bapache/\d"
    r"|traceback \(most recent call last\)|stack trace|\b\w+(?:error|exception): |nullpointerexception|\bat [\w$.]+\([\w$]+\.java:|segmentation fault|(?:warning|notice|fatal error|parse error): .{0,80} on line|core dumped|unhandled|undefined (?:variable|index|function)"
    r"|verify(?:ing)? (?:that )?you(?:'re| are) (?:a )?human|captcha|checking your (?:browser|connection)|ray id|just a moment\.\.\."
    r"|scheduled maintenance|(?:under|down for) maintenance|be right back|temporarily (?:unavailable|out of service|down)|site is (?:offline|down)"
    r"|\"(?:error|errors|success|status)\"\s*:\s*(?:\{|false|\"(?:error|fail)|[45]\d\d)|<error>|<code>\w+</code>|<title>\s*(?:error|\d{3})"
    r"|accès refusé|page introuvable|n'a pas été trouvée?|introuvable|erreur (?:\d{3}|interne|serveur|inattendue)|une erreur (?:interne |inattendue )?(?:s'est produite|est survenue)|service (?:temporairement )?indisponible|session (?:a )?expirée?|en maintenance|trop de requêtes"
    r"|acceso denegado|página no encontrada|no se encontró la página|error interno|se produjo un error|ha ocurrido un error|servicio (?:temporalmente )?no disponible|sesión (?:ha )?(?:expirado|caducado)|en mantenimiento|demasiadas solicitudes"
    r"|zugriff verweigert|seite (?:wurde )?nicht gefunden|wurde nicht gefunden|interner (?:server)?fehler|ein fehler ist aufgetreten|fehler \d{3}|nicht verfügbar|sitzung (?:ist )?abgelaufen|wartungsarbeiten|zu viele anfragen"
    r"|アクセスが拒否|アクセスが集中|しばらくしてから再度|アクセスできません|ページが見つかりません|見つかりませんでした|削除されたか|非公開です|エラーが発生|内部エラー|メンテナンス中|タイムアウト|セッション(?:の有効期限|が切れ)|混み合って|利用できません"
    r"|访问被拒绝|拒绝访问|找不到页面|页面不存在|页面未找到|不存在或已被删除|已被删除|服务器(?:内部)?错误|发生错误|出错了|出现错误|暂时(?:无法|不可用)|服务不可用|请求超时|连接超时|维护中|会话已过期|请求过于频繁"
)
SCRIPTS = re.compile(
    r"(?:enable|turn on|activate|allow|needs?|requiere|necesita|nécessite|exige|verlangt|requires?|required|without|disabled|switched off|turned off|activer|activez|désactivé|activar|active|habilit\w+|desactivado|aktivieren|deaktiviert|benötigt|erforder\w+|有効|無効|必要|启用|开启|禁用|需要)[^.!?。！？]{0,60}(?:javascript|java script|scripts?\b)"
    r"|(?:javascript|java script|scripts?\b)[^.!?。！？]{0,60}(?:enable|turn(?:ed)? o|activ|disabled|required|needed|switched off|blocked|off\b|désactiv|desactiv|habilit|deaktiv|aktiv|benötigt|erforder|necesari|nécessaire|有効|無効|必要|启用|开启|禁用|需要)"
)
FILLER = re.compile(
    r"lorem ipsum|blah,? blah|bla,? bla|(?:text|copy|content|description|name|title|story) (?:for .{1,60} )?goes here|\bgoes here\b|sample text|dummy text|placeholder text|filler text|this is (?:a )?placeholder"
    r"|coming soon|under construction|check back (?:later|soon)|insert .{1,60} here|replace (?:it|this) with|your text here|to be (?:written|added|announced)|work in progress|asdf|qwerty"
    r"|blindtext|platzhalter|mustertext|folgt in kürze|texte? de remplissage|texte provisoire|à remplacer|à compléter|bientôt disponible|texto de relleno|texto de (?:ejemplo|prueba)|próximamente|por completar"
    r"|ダミーテキスト|サンプルテキスト|仮の(?:文章|テキスト)|準備中|ここに.{0,12}(?:入|書)|占位(?:文字|文本|符)|示例文本|测试文本|敬请期待|此处(?:填写|输入|为)"
)
#: Words that by themselves prove little: they count only in a message that recurs over several sources.
WEAK = re.compile(r"\berror\b|\bfailed\b|unavailable|not found|\bpending\b|maintenance|\bplaceholder\b|\btodo\b|\btbd\b|\bdraft\b|incident|reference #|\bref\b|erreur|fehler|incidente|エラー|错误")
# The pseudo-Latin of filler text.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim "
    "veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum "
    "eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum pellentesque "
    "habitant morbi tristique senectus netus malesuada fames ac turpis egestas vestibulum tortor quam feugiat vitae ultricies eget mauris".split()
)
_ADDRESS = re.compile(r"(?:https?://|www\.)\S+|(?<![\w<])/[\w.%\-]+(?:/[\w.%\-]*)*")
_CODE = re.compile(r"\b(?=[a-z]*\d)[0-9a-f]{6,}\b|\b[0-9a-f]{8}-[0-9a-f-]{20,}\b")
_DATE = re.compile(r"\d{1,4}[./\-年]\d{1,2}[./\-月]\d{1,4}日?|\d{1,2}:\d{2}(?::\d{2})?")
_DIGIT = re.compile(r"\d")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_NAME = re.compile(r"(?<=[\w,;:(] )[A-Z][\w'’\-]+(?: [A-Z][\w'’\-]+)*|[ァ-ヺー]{3,}")
_TITLE = re.compile(r"\A[^\n.!?。！？]{1,60}\n+")

#: A record longer than this isn't a message as a whole, but for markup, JSON and stack traces; slots and pseudo-Latin are
#: looked for in texts of any length.
MESSAGE_CHARS, MARKUP_CHARS = 250, 2000
_MARKUP = re.compile(r"\A\s*(?:<|\{\s*\"(?:error|success|status|code|message)|Traceback|[\w.]+(?:Exception|Error): )")


_SLOT_SIGNS = ("{", "(insert ", "(enter ", "(fill in ", "(insérer ", "(insertar ", "(einfügen ", "(hier ", "<", "[", "%", "$", "@@", "_", "【", "〔", "［", "○", "〇", "×", "undefined")
_ASCII_LETTERS = "".join(chr(i) if chr(i).isalpha() else " " for i in range(128))


def latin_share(text: str) -> float:
    """The share of pseudo-Latin among the words of a text."""
    low = text.lower()
    found = low.translate(_ASCII_LETTERS).split() if low.isascii() else re.findall(r"[a-zà-ÿ]+", low)
    return sum(map(LATIN.__contains__, found)) / len(found) if found else 0.0


def is_short(text: str) -> bool:
    """Whether a text may be one message as a whole."""
    return len(text) <= MESSAGE_CHARS or len(text) <= MARKUP_CHARS and _MARKUP.match(text) is not None


def has_slot(text: str) -> bool:
    """Whether a text holds an unfilled slot; a text without any sign that slots begin with needs no pattern."""
    return any(sign in text for sign in _SLOT_SIGNS) and SLOTS.search(text) is not None


def masked(text: str) -> str:
    """A message with its addresses, codes, dates, numbers and proper names masked and white space evened out."""
    text = _TITLE.sub("", text.strip(), count=1) or text
    text = fold(_NAME.sub("@", text))
    if "/" in text or "www." in text:
        text = _ADDRESS.sub("§a", text)
    if _DIGIT.search(text):
        for pattern, sign in ((_CODE, "§c"), (_DATE, "§d"), (_NUMBER, "#")):
            text = pattern.sub(sign, text)
    return " ".join(text.split())


def message_kind(text: str, sources: int = 1) -> str | None:
    """error, script or filler if a short text is such a message; weak words count from three sources on."""
    low = fold(text).replace("’", "'").replace("&quot;", '"')
    if SCRIPTS.search(low) and ("script" in low):
        return "script"
    if ERRORS.search(low):
        return "error"
    if FILLER.search(low):
        return "filler"
    if sources >= SOURCES and len(low) < 200 and WEAK.search(low):
        return "error"
    return None


def kind(text: str | None) -> str | None:
    """slot, filler, error or script by what the text itself shows, whatever recurs elsewhere; null and blank texts are none."""
    if not isinstance(text, str) or not text.strip():
        return None
    if has_slot(text):
        return "slot"
    if len(text.split(None, 6)) > 5 and latin_share(text) > 0.5:
        return "filler"
    return message_kind(text) if is_short(text) else None


#: Sources over which a message has to recur before weak words count, and before a long text can be one; the share of its characters
#: that must stand in sentences of messages then.
SOURCES, MESSAGE_SHARE = 3, 0.5
#: Keys (16 bytes each) that are broadcast at most.
BROADCAST_ROWS = 1_000_000
_SENTENCE = re.compile(r"[^.!?。！？\n>]+[.!?。！？>]*")


def long_kind(text: str) -> str | None:
    """error, script or filler if most of a text of any length stands in sentences that are such messages; the kind of most of it."""
    chars: dict[str | None, int] = {}
    for part in _SENTENCE.findall(text):
        found = message_kind(part)
        chars[found] = chars.get(found, 0) + len(part.strip())
    total, plain = sum(chars.values()), chars.pop(None, 0)
    return max(chars, key=chars.__getitem__) if chars and total - plain >= MESSAGE_SHARE * total else None


@F.pandas_udf(T.StructType([T.StructField("own", T.StringType()), T.StructField("group", T.LongType()), T.StructField("short", T.BooleanType())]))
def _looked_at(texts: pd.Series) -> pd.DataFrame:
    """What texts show by themselves, whatever recurs; for the others the hash of the masked text."""
    rows = []
    for t in texts:
        if not isinstance(t, str) or not t.strip():
            rows.append((None, None, None))
            continue
        short = is_short(t)
        own = "slot" if has_slot(t) else None if short else kind(t)
        rows.append((own, None if own else h64(masked(t)), short))
    return pd.DataFrame(rows, columns=["own", "group", "short"])


@F.pandas_udf(T.StringType())
def _group_kind(texts: pd.Series, sources: pd.Series) -> pd.Series:
    return pd.Series([kind(t) or message_kind(t, int(n)) for t, n in zip(texts, sources)], dtype=object)


@F.pandas_udf(T.StringType())
def _long_kind(texts: pd.Series) -> pd.Series:
    return pd.Series([long_kind(t) for t in texts], dtype=object)


def residue(*tables: DataFrame, key: str = "rec_id", text: str = "output", source: str = "metadata.source_id") -> DataFrame:
    """(key, kind): the records that hold an unfilled slot (``slot``) or are ``filler``, an ``error`` or a demand for a ``script``.

    Texts of any length are masked (numbers, codes, addresses, dates, proper names) and grouped over all tables by the hash of
    what is left; rows and sources are counted with partial sums before the shuffle, and one text stands for its group. A short
    message (up to 250 characters, 2,000 for markup, JSON and stack traces) is classified by the phrase rules, weak words
    counting only where it recurs over three sources or more; a longer text only where it recurs so, and if at least half of it
    stands in such messages. Slots and pseudo-Latin are looked for in texts of any length, in whole. Null or blank texts are no
    case; rows with a null key are left out; equal rows give equal results, once per row. Only hashes, sources and one message per
    group are shuffled, and of long texts those that stand for a recurring group.
    """
    rows = reduce(
        DataFrame.unionByName,
        [take(t, **{key: key, "source": source_key(F.col(source)), "text": text}) for t in tables],
    ).where(F.col(key).isNotNull() & F.col("text").isNotNull())
    looked = rows.withColumn("x", _looked_at("text"))
    seen = looked.select(key, "source", "x.own", "x.group", "x.short", F.when(F.col("x.short") & F.col("x.own").isNull(), F.col("text")).alias("sample"))
    # read several times below: without the file every reading would look at all texts again
    seen = stored(seen.where("own is not null or group is not null"), "residue")
    messages = seen.where("group is not null")
    groups = (
        messages.groupBy("group", "source", "short").agg(F.min("sample").alias("sample"), F.min(key).alias("first"))
        .groupBy("group", "short").agg(F.min("sample").alias("sample"), F.min("first").alias("first"), F.count("source").alias("sources"))
    )
    short = groups.where("short").select("group", _group_kind("sample", "sources").alias("kind"))
    recurring = groups.where(~F.col("short") & (F.col("sources") >= SOURCES)).select("group", F.col("first").alias("k"))
    # only the texts that stand for long groups are fetched, by their keys alone: so many keys are broadcast, more are joined by a shuffle
    recurring = stored(recurring, "recurring")
    wanted = F.broadcast(recurring) if recurring.count() <= BROADCAST_ROWS else recurring
    standing = stored(rows.join(wanted, F.col(key) == F.col("k")).groupBy("group").agg(F.min("text").alias("text")), "standing")
    classified = short.unionByName(standing.select("group", _long_kind("text").alias("kind"))).where("kind is not null")
    return (
        messages.select(key, "group").join(classified, "group").select(key, "kind")
        .unionByName(seen.where("own is not null").select(key, F.col("own").alias("kind")))
    )
