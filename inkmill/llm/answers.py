"""Problem 5: pairs of prompt and response whose response doesn't answer."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import take, turns
from .pages import furniture_lines
from .residue import kind
from .text import CJK, fold, squeeze

# Stand-ins for "nothing", letters and digits only.
NOTHING = frozenset(
    "na none null nil nan empty blank nothing void noanswer noresponse nooutput nodata nocontent notavailable notapplicable nbsp undefined "
    "keine leer keineantwort nichts ninguno ninguna nada vacío sinrespuesta aucun aucune rien vide sansréponse なし 無し 空 空白 該当なし 回答なし 无 無 空内容 无内容 暂无 没有".split()
)
# How an assistant declines, folded, at the start of its answer.
REFUSAL = re.compile(
    r"(?:(?:i'?m|i am) (?:very |so |really )?sorry|sorry|my apologies|apologies|i apologi[sz]e|unfortunately)\b.{0,160}?\b(?:can'?t|cannot|can not|unable|not able|won'?t|decline|must decline|not (?:allowed|permitted)|not comfortable)\b"
    r"|i (?:can'?t|cannot|can not|won'?t|will not|must decline|decline|am unable|am not able|do not feel comfortable|don'?t feel comfortable|am not comfortable|'m unable|'m not able)\b.{0,120}?\b(?:help|assist|fulfil\w*|complete|comply|continue|provide|write|answer|produc\w*|creat\w*|describ\w*|discuss|generat\w*|engage|request|do that)\b"
    r"|as an? (?:ai|artificial intelligence|language model|large language model)\b|this (?:request|prompt) .{0,100}(?:can'?t|cannot) be answered"
    r"|(?:je suis |)(?:désolée?|navrée?)\b.{0,40}\bje ne (?:peux|puis)|je (?:ne peux|ne puis|regrette|refuse)\b.{0,40}(?:répondre|aider|décrire|écrire|continuer|demande)|en tant que (?:modèle|ia|intelligence)|malheureusement,? je ne (?:peux|puis)"
    r"|lo siento,?.{0,30}\bno puedo|no puedo (?:ayudar|describir|responder|escribir|continuar|cumplir)|como (?:modelo de lenguaje|ia\b|inteligencia artificial)|lamentablemente,? no puedo|me temo que no puedo"
    r"|(?:es )?tut mir (?:sehr )?leid\b.{0,120}(?:nicht|ablehnen)|leider (?:kann|darf|muss) ich\b.{0,120}(?:nicht|ablehnen)|als (?:ki|sprachmodell|künstliche intelligenz)\b|ich kann (?:diese|dieser|bei) .{0,80}nicht"
    r"|(?:大変)?申し訳(?:ありません|ございません).{0,60}(?:できません|お応えできません|できかねます|お断り)|(?:ai|人工知能|言語モデル|ai言語モデル)として.{0,80}(?:できません|ません)|(?:ご依頼|ご要望).{0,20}(?:お応えできません|できません)"
    r"|(?:很|非常)?(?:抱歉|对不起|遗憾).{0,40}(?:无法|不能|不便)|作为(?:一个|一名)?(?:ai|人工智能|语言模型|大型语言模型).{0,60}(?:无法|不能)|我(?:无法|不能)(?:回答|描述|提供|协助|继续|满足)"
)
_LEAD = re.compile(
    r"^(?:you asked|you said|your question|the question|question|prompt|instruction|q|user|human|frage|ihre frage|deine frage|pregunta|preguntaste|ha preguntado|su pregunta|vous avez demandé|votre question|la question"
    r"|du hast gefragt|sie haben gefragt|質問|ご質問|お尋ね|问题|提问|你问|您问|您的问题)\s*(?:was|war|est|es|は|是)?\s*[:：\-–—]?\s*"
)
# Frequent short words by language.
STOPWORDS = {
    "en": "the and of to in is was that with for from by are as at who this not or but which near every what how does do give tell write into when she he it its they".split(),
    "fr": "le la les des et un une est dans que qui pour avec sur par au aux du ne pas se ce cette il elle était avait sous si bien mais ses son sa quand où pourquoi comment veut raconte décris explique continue quelle quel entre".split(),
    "de": "der die das und den dem des ein eine einer ist nicht mit von zu im auf für als auch sich war wie wer nach bei aus dass wenn oder unter noch vom zum zwischen warum erzähle beschreibe erkläre setze fort welche leuten".split(),
    "es": "el la los las y un una que es en de con por para no se su del al lo como más pero sus era desde bajo cuando quien hasta había entre cuenta cuéntame describe explica continúa qué quién dónde cómo gente quiere dejó".split(),
    "it": "il lo gli e di che è un una non per con del della nel sono era come più ma alla dei".split(),
    "pt": "o os e de que é um uma não para com do da em no na dos das era como mais mas pelo seu sua".split(),
    "nl": "de het een en van is niet met op voor dat te in zijn was aan ook als bij door om".split(),
}
_STOP = {w: tuple(code for code, ws in STOPWORDS.items() if w in ws) for ws in STOPWORDS.values() for w in ws if len(w) > 1}
_NOISE = re.compile("[#¤§^~|\ufffd]|(?<=[^\\W\\d_])[01](?=[^\\W\\d_])")
# Names of languages in the languages of the questions.
NAMES = {
    "en": "english|anglais|inglés|englisch|英語|英语|英文",
    "fr": "french|français|francés|französisch|フランス語|仏語|法语|法文",
    "de": "german|allemand|alemán|deutsch|ドイツ語|独語|德语|德文",
    "es": "spanish|espagnol|español|spanisch|castellano|スペイン語|西班牙语|西班牙文",
    "ja": "japanese|japonais|japonés|japanisch|日本語|日语|日文",
    "zh": "chinese|mandarin|chinois|chino|chinesisch|中国語|中文|汉语|漢語",
    "it": "italian|italien|italiano|italienisch",
    "pt": "portuguese|portugais|portugués|portugiesisch",
    "ko": "korean|coréen|coreano|koreanisch|韓国語|韩语",
}
_ASKED = {
    code: re.compile(
        rf"\b(?:in|into|en|auf|sprache|langue|idioma|em)\b[\s«»„“\"'‹›‚‘()の「」]*(?:the |la |der |dem |el |lengua |langue |language |sprache |idioma )*[\s«»„“\"'‹›‚‘「」]*(?:{names})\b|(?:{names})(?:で|に訳|にて|来|写|回答|描述|讲述)|(?:用|以|使用)[\s“”「」\"«»]*(?:{names})|[«»„“\"「」『』](?:{names})[»«“”\"「」『』]"
    )
    for code, names in NAMES.items()
}
_KANA = re.compile("[぀-ヿㇰ-ㇿ]")
_HIRAGANA = re.compile("[぀-ゟ]")
_LATIN = re.compile(r"[a-zà-öø-ÿœß]+")
_MARKUP = re.compile(r"<[^<>]{0,200}>|&(?:[a-z]+|#\d+);|```\w*")
_CLOSERS = r"[\s\"'”’»›」』】〉》)\]}*_~`​]*"
_TERMINAL = re.compile(rf"[.!?。！？．…؟]{_CLOSERS}$")
_ANY_TERMINAL = re.compile(r"[.!?。！？．][\"'”’»」』)\]]*(?:\s|$|(?<=[。！？．])|(?<=[。！？][」』”]))")
_FIELD = re.compile(r"^[\s>*#\-]*[^\W\d_][\w '’\-]{0,24}[*_]*\s*[:：]\s*\S")
_CLOSING = re.compile(r"^\s*(?:[—–\-~]\s*\S|[*•]\s|\d+[.)]\s|\(.*\)\s*$|[*\-_=~#\s]+$|#)")
# Words no sentence ends with.
_OPEN_WORD = frozenset(
    "the a an and of to in with for from by at who which that every or but nor as into whose than because although while unless until since so "
    "le la les des du de et un une au aux dans qui que pour par sur son sa ses ou mais car puisque tandis lorsque "
    "der die das den dem des ein eine einer einem und oder mit von zu im am auf für als dass weil wenn bei "
    "el los las y una con por del al su sus que o pero porque aunque mientras hasta".split()
)
_OPEN_END = re.compile(r"[,;:、，；：]\s*$|(?:而且|但是|因为|以及|和|与|的|が、|そして|しかし)$")


def language_of(text: str, least: int = 2) -> str | None:
    """ja, zh, ko or a language of ``STOPWORDS``; None if the text shows too little or too mixed evidence."""
    low = fold(text)
    cjk, latin = len(CJK.findall(low)), sum(map(len, _LATIN.findall(low)))
    if cjk >= 4 and 3 * cjk > latin:
        if re.search("[가-힯]", low):
            return "ko"
        if len(_KANA.findall(low)) * 12 >= cjk and (_HIRAGANA.search(low) or len(_KANA.findall(low)) * 2 > cjk):
            return "ja"
        return "zh"
    count: dict[str, int] = {}
    total = 0
    for w in _LATIN.findall(low):
        total += 1
        for code in _STOP.get(w, ()):
            count[code] = count.get(code, 0) + 1
    if not count:
        return None
    ranked = sorted(count.values(), reverse=True)
    best = max(count, key=count.__getitem__)
    if ranked[0] < least or len(ranked) > 1 and ranked[1] * 1.3 >= ranked[0] or ranked[0] * 10 < total:
        return None
    return best


def asked_language(question: str) -> str | None:
    """The language a question asks its answer to be in, or that it is written in."""
    low = fold(question)
    for code, pattern in _ASKED.items():
        if pattern.search(low):
            return code
    return language_of(question, 1)


def is_empty(answer: str | None) -> bool:
    if not isinstance(answer, str):
        return True
    left = squeeze(_MARKUP.sub(" ", answer))
    return not left or len(left) <= 20 and left in NOTHING


def is_copy(question: str, answer: str) -> bool:
    q = squeeze(question)
    if len(q) < 8:
        return False
    a = squeeze(answer)
    if a in (q, q * 2, q * 3):
        return True
    if len(a) > 2 * len(q) + 60:
        return False
    bare = squeeze(_LEAD.sub("", fold(answer).lstrip(" \t\n\"'“„«「*>#-")))
    return bare in (q, q * 2)


def ending(answer: str) -> str | None:
    """How an answer ends that ends without a full stop: cut (inside a sentence), open (it might be whole), or None."""
    text = answer.strip(" \t\r\n​ ﻿")
    if text[:1] in "{[" and '"' in text[:60] and text[-1:] not in "}]":
        return "cut"
    if _TERMINAL.search(text) or text[-1:] in "}]>":
        return None
    stopped = _ANY_TERMINAL.search(text)
    last = text.rsplit("\n", 1)[-1]
    words = re.findall(r"\w+", fold(last))
    loose = _OPEN_END.search(text) or words and words[-1] in _OPEN_WORD
    if not stopped:  # no full stop anywhere: punctuation may be no part of its form
        return "cut" if loose and re.search("[,，、]", text) and len(text) > 60 else None
    if _FIELD.match(last) or _CLOSING.match(last):
        return None
    if loose or _ANY_TERMINAL.search(last):
        return "cut"
    return "open"


def defect(question: str | None, answer: str | None) -> str | None:
    """empty, refusal, copy, language or truncated by what the pair itself shows; "open" if its end leaves that open."""
    if is_empty(answer):
        return "empty"
    if kind(answer):
        return None
    low = fold(answer).replace("’", "'").strip(" \t\n\"'“„«「*>#-")
    if len(low) <= 500 and REFUSAL.match(low):
        return "refusal"
    if isinstance(question, str) and question.strip():
        if is_copy(question, answer):
            return "copy"
        if len(answer) >= 40 and 40 * len(_NOISE.findall(answer)) < len(answer):
            of = language_of(answer, 5)
            asked = asked_language(question)
            # a question whose language its few words leave open still shows its script
            if of and (asked != of if asked else of in ("ja", "zh", "ko") and not CJK.search(question)):
                return "language"
    found = ending(answer)
    if found and furniture_lines(answer):
        return None
    return {"cut": "truncated"}.get(found, found)


@F.pandas_udf(T.StructType([T.StructField("defect", T.StringType()), T.StructField("form", T.StringType())]))
def _judged(questions: pd.Series, answers: pd.Series) -> pd.DataFrame:
    rows = [(defect(q, a), squeeze(a) if isinstance(a, str) else None) for q, a in zip(questions, answers)]
    return pd.DataFrame(rows, columns=["defect", "form"])


def last_exchange(dpo: DataFrame, key: str = "rec_id", conversations: str = "conversations") -> DataFrame:
    """(id, question, answer): the last human turn of each conversation and the gpt turn after it, null where there is none."""
    t = turns(conversations)
    numbered = take(dpo, id=F.col(key).cast("long"), t=t)
    last = F.array_max(F.transform("t", lambda x, i: F.when(x["role"] == "human", i)))
    at = numbered.withColumn("last", F.coalesce(last, F.lit(-1)))
    after = F.filter("t", lambda x, i: (i > F.col("last")) & (x["role"] == "gpt"))
    return at.select(
        "id",
        F.when(F.col("last") >= 0, F.col("t")[F.col("last")]["value"]).alias("question"),
        F.get(after, F.lit(0))["value"].alias("answer"),
    )


def shortened(rows: DataFrame) -> DataFrame:
    """(id) of the rows with ``open`` ends of which another row is a longer version: the next text in sorted order begins with it.

    Rows are (id, form, open). They are sorted over all partitions; each partition compares neighbours and hands its first
    text and its unresolved last run on, so that neighbours across a boundary are compared too.
    """
    ordered = rows.repartitionByRange("form").sortWithinPartitions("form")
    schema = "part int, id long, form string, what string"

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        run, waiting, out, first = None, [], [], True
        for b in batches:
            for i, form, is_open in zip(b["id"], b["form"], b["open"]):
                if first:
                    out.append((part, None, form, "first"))
                    first = False
                if form != run:
                    if run is not None and form.startswith(run):
                        out += [(part, w, None, "shortened") for w in waiting]
                    run, waiting = form, []
                if is_open:
                    waiting.append(i)
            yield pd.DataFrame(out, columns=["part", "id", "form", "what"])
            out = []
        yield pd.DataFrame([(part, w, run, "last") for w in waiting], columns=["part", "id", "form", "what"])

    seen = ordered.mapInPandas(neighbours, schema)
    edges = seen.where("what <> 'shortened'").withColumn(
        "next",
        F.first(F.when(F.col("what") == "first", F.col("form")), ignorenulls=True).over(
            Window.orderBy("part").rangeBetween(1, Window.unboundedFollowing)
        ),
    )
    across = edges.where("what = 'last' and next <> form and startswith(next, form)")
    return seen.where("what = 'shortened'").select("id").union(across.select("id"))


def defects(pairs: DataFrame, spike_rows: int = 20, spike_share: float = 0.3) -> DataFrame:
    """(id, defect) of the pairs (id, question, answer) whose answer doesn't answer; at most one defect a pair.

    The first that fits of: ``empty``, ``refusal``, ``copy``, ``language``, ``truncated``. Residue (see ``residue``) is none.
    An answer that ends without a full stop is truncated if it breaks off within a line that has other sentences, after a comma
    or after a word that ends no sentence; where its end leaves that open, if a longer version of it stands next to it in sorted
    order, or if its length is one at which answers break off conspicuously often (at least ``spike_rows`` and ``spike_share``
    of the answers of this length). Null keys are left out, null answers are empty, null questions allow neither copy nor
    language; equal rows give equal results.
    """
    judged = pairs.where("id is not null").withColumn("x", _judged("question", "answer")).select("id", "x.defect", "x.form", F.length("answer").alias("chars"))
    judged = stored(judged.withColumn("open", F.coalesce(F.col("defect") == "open", F.lit(False))), "judged")
    short = shortened(judged.where("form <> '' and (defect is null or defect in ('open', 'truncated'))").select("id", "form", "open"))
    cut = F.sum(F.when(F.col("defect").isin("truncated", "open"), 1).otherwise(0))
    spikes = judged.groupBy("chars").agg(F.count("*").alias("n"), cut.alias("cut")).where((F.col("cut") >= spike_rows) & (F.col("cut") >= spike_share * F.col("n")))
    spiked = judged.where("open").join(spikes, "chars", "left_semi").select("id")
    sure = judged.where("defect is not null and not open").select("id", "defect")
    return sure.union(short.union(spiked).distinct().select("id", F.lit("truncated").alias("defect")))
