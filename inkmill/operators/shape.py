"""Records for training from chunks: labels, prompts, instruction records, conversations, preference pairs."""

from __future__ import annotations

import json
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.fixed import WS
from ..functions.text import lines, lookup, pick, roll, sentences, strip, token_estimate, word_count, words
from .chunk import sound_chunks
from .dedup import exact_first


def first_sentence(x: Column) -> Column:
    """The text up to the first mark that white space follows, within the first line; null without one."""
    found = F.regexp_extract(x, f"(?d)^(.+?[.!?]){WS}", 1)
    return F.when(found != "", found)


def topic(chunk: Column) -> Column:
    """A heading, else the first words of the first sentence without small words, else the first words."""
    head = strip(F.coalesce(F.get(lines(strip(chunk)), F.lit(0)), F.lit("")))
    titled = head.rlike(r"^[\p{Lu}\p{Lt}]") | (~head.rlike(r"\p{Ll}") & head.rlike(r"\p{Lu}")) | (
        head.rlike(r"\p{Lu}") & ~head.rlike(r"(?<!\p{L})\p{Ll}|(?<=\p{L})\p{Lu}")
    )
    short = (head != "") & (word_count(head) <= 8) & titled
    small = F.array(*[F.lit(w) for w in fixed.TOPIC_STOP])
    rest = F.filter(words(first_sentence(chunk)), lambda w: ~F.array_contains(small, F.lower(w)))
    return F.when(short, F.substring(head, 1, 80)).otherwise(
        F.coalesce(F.array_join(F.slice(rest, 1, 8), " "), F.array_join(F.slice(words(chunk), 1, 8), " "))
    )


def derived_prompt(chunk: Column, before: Column) -> Column:
    """The last sentence of the chunk before, if of five words or more; else the first sentence; else the first 20 words."""
    last = strip(F.element_at(sentences(before, ".!?"), -1))
    return F.when((before != "") & (word_count(last) >= 5), F.substring(last, 1, 200)).otherwise(
        F.coalesce(F.substring(first_sentence(chunk), 1, 200), F.array_join(F.slice(words(chunk), 1, 20), " "))
    )


def genre(tags: Column, table: dict[str, str] = fixed.GENRES, default: str = fixed.GENRE_DEFAULT) -> Column:
    """The label of the first known tag."""
    known = F.array(*[F.lit(k) for k in table])
    first = F.get(F.filter(tags, lambda t: F.array_contains(known, t)), F.lit(0))
    return F.coalesce(F.when(first.isNotNull(), lookup(first, table)), F.lit(default))


def sentiment(x: Column) -> Column:
    """The label of the lexicon most of whose words occur; action wins only over both others."""
    seen = F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"(?U)\b[a-z]+\b"), F.lit(0)))
    pos, neg, act = (F.size(F.array_intersect(seen, F.array(*[F.lit(w) for w in ws]))) for ws in (fixed.POSITIVE, fixed.NEGATIVE, fixed.ACTION))
    s = fixed.SENTIMENTS
    return F.when((act > pos) & (act > neg), s["action"]).when(neg > pos, s["negative"]).when(pos > neg, s["positive"]).otherwise(s["neutral"])


_SINGLE = re.compile(r"\b[A-Z][a-z]{2,}\b")
_RUN = re.compile(r"\b[A-Z][a-z]{1,20}(?:\s+[A-Z][a-z]{1,20}){0,2}\b")
_CALLED = re.compile(rf"the\s+([A-Z][a-zA-Z\s]{{2,40}}?)\s*(?:\b(?:{'|'.join(fixed.ORGANISATIONS)})\b)", re.IGNORECASE)
_BARE = re.compile(rf"\b[A-Z][a-z]{{2,20}}(?:\s+[A-Z][a-z]{{2,20}}){{0,2}}\s+(?:{'|'.join(fixed.BARE_ORGANISATIONS)})\b")
_PAIR = re.compile(r"\b([A-Z][a-z]{2,15})\s+([A-Z][a-z]{2,15})\b")
_FACTION = re.compile(rf"\b[A-Z][a-z]{{2,15}}(?:\s+[A-Z][a-z]{{2,15}})?\s+(?:{'|'.join(fixed.LORE_FACTIONS)})\b")
_NO_PART, _NUMBERS = frozenset(fixed.NOT_NAMES + fixed.NUMBER_WORDS), frozenset(fixed.NUMBER_WORDS)


def named(text: str) -> tuple[list[str], list[str]]:
    """(names, organisations) of an English text: up to 10 and 8, in order of code points.

    A name of one word has four letters and occurs twice, the words of a longer one have three; none is a word of the fixed lists,
    and a name that is part of an organisation is left to it.
    """
    often = Counter(_SINGLE.findall(text))
    orgs = {" ".join(w.capitalize() for w in m.group(0).split()) for m in _CALLED.finditer(text)}
    orgs |= {o for o in _BARE.findall(text) if _NUMBERS.isdisjoint(o.split()[:-1])}
    names = []
    for name in sorted(set(_RUN.findall(text))):
        parts = name.split()
        whole = len(name) >= 4 and often[name] >= 2 if len(parts) == 1 else all(len(p) >= 3 for p in parts)
        if whole and _NO_PART.isdisjoint(parts) and not any(name in o for o in orgs):
            names.append(name)
    return names[:10], sorted(orgs)[:8]


@F.pandas_udf(T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("names", "organisations")]))
def entities(texts: pd.Series) -> pd.DataFrame:
    """``named`` as a column; nulls for null."""
    found = [named(t) if isinstance(t, str) else (None, None) for t in texts]
    return pd.DataFrame(found, columns=["names", "organisations"])


def filled(template: list[str], number: Column, **values: Column) -> Column:
    """The template of this number with its slots filled."""
    text = F.element_at(F.array(*[F.lit(t) for t in template]), (number + 1).cast("int"))
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return text


def sharegpt(system: Column, human: Column, gpt: Column) -> Column:
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    return F.array(turn("system", system), turn("human", human), turn("gpt", gpt))


def as_alpaca(records: DataFrame) -> DataFrame:
    """(instruction, input, output, metadata) of ``alpaca``, as they are written; missing fields of the metadata have their defaults."""
    text = lambda c, default="": F.coalesce(F.col(c), F.lit(default)).alias(c)
    metadata = F.struct(
        text("source_id"), text("source_url"), text("category", "trpg"), text("display_name"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), text("language", "en"), "chunk_index", "word_count",
    )
    return records.select("instruction", "input", "output", metadata.alias("metadata"))


def as_stories(records: DataFrame) -> DataFrame:
    """(conversations) of ``story_pairs``: the system prompt names the genre, in Japanese for Japanese texts."""
    lead = F.when(F.col("language") == "ja", fixed.STORY_SYSTEM_JA).otherwise(fixed.STORY_SYSTEM)
    return records.select(sharegpt(F.replace(lead, F.lit("{genre}"), F.col("genre")), F.col("human"), F.col("gpt")).alias("conversations"))


def as_analyst(records: DataFrame) -> DataFrame:
    """(conversations) of ``analyst``."""
    return records.select(sharegpt(F.when(F.col("task") == "ner", fixed.NER_SYSTEM).otherwise(fixed.SENTIMENT_SYSTEM), F.col("human"), F.col("gpt")).alias("conversations"))


def as_translations(records: DataFrame) -> DataFrame:
    """(conversations) of ``translations``: the system prompt names both languages."""
    name = lambda c: lookup(F.col(c), fixed.LANGUAGE_NAMES)
    system = F.replace(F.replace(F.lit(fixed.TRANSLATOR_SYSTEM), F.lit("{src_lang}"), name("source_language")), F.lit("{tgt_lang}"), name("target_language"))
    return records.select(sharegpt(system, F.col("human"), F.col("gpt")).alias("conversations"))


def as_dpo(pairs: DataFrame) -> DataFrame:
    """(prompt, chosen, rejected) of ``dpo``, each answer with its system turn before it."""
    both = lambda system, gpt: F.array(*[F.struct(F.lit(who).alias("from"), F.col(c).alias("value")) for who, c in (("system", system), ("gpt", gpt))])
    return pairs.select("prompt", both("chosen_system", "chosen").alias("chosen"), both("rejected_system", "rejected").alias("rejected"))


def unique_chunks(pages: DataFrame, max_words: int, min_words: int = 80, prefix: str = "") -> DataFrame:
    """Sound chunks of all pages, each text once (the first by category, source, url and page), with their place and the
    chunks before and after them among the survivors of their page."""
    chunks = exact_first(sound_chunks(pages, max_words, min_words), "chunk", "category", "source_id", "url", "doc_id", "pos", prefix=prefix)
    page = Window.partitionBy("doc_id").orderBy("pos")
    return (
        chunks.withColumn("chunk_index", (F.row_number().over(page) - 1).cast("long"))
        .withColumn("before", F.lag("chunk").over(page))
        .withColumn("after", F.lead("chunk").over(page))
    )


def alpaca(chunks: DataFrame, literature: bool, seed: str = "42") -> DataFrame:
    """Instruction records; the template is picked by a hash of seed, kind, page and place."""
    kind = "literature" if literature else "rpg"
    prompts = fixed.LITERATURE_PROMPTS if literature else fixed.RPG_PROMPTS
    number = pick(len(prompts), seed, kind, F.col("doc_id"), F.col("chunk_index"))
    if literature:
        instruction = filled(prompts, number, genre=genre(F.col("tags")), derived_prompt=derived_prompt(F.col("chunk"), F.col("before")))
    else:
        system = lookup(F.coalesce("display_name", "source_id", F.lit("TRPG")), fixed.SYSTEM_NAMES)
        instruction = filled(prompts, number, system=system, topic=topic(F.col("chunk")))
    return chunks.select(
        "doc_id",
        "chunk_index",
        instruction.alias("instruction"),
        F.lit("").alias("input"),
        F.col("chunk").alias("output"),
        "source_id",
        F.col("url").alias("source_url"),
        "category",
        "display_name",
        "tags",
        "language",
        word_count(F.col("chunk")).alias("word_count"),
    )


def story_pairs(chunks: DataFrame, seed: str = "42") -> DataFrame:
    """Chunk to next chunk: the human turn ends with the last sentences of the one, the other is the answer."""
    s = sentences(F.col("chunk"))
    tail = strip(F.array_join(F.slice(s, F.greatest(F.size(s) - 1, F.lit(1)), 2), " "))
    context = F.when(word_count(tail) < 10, strip(F.substring(F.col("chunk"), -300, 300))).otherwise(tail)
    key = (seed, "story", F.col("doc_id"), F.col("chunk_index"))
    ja, other = fixed.CONTINUATION_PROMPTS_JA, fixed.CONTINUATION_PROMPTS
    lead = F.when(F.col("language") == "ja", filled(ja, pick(len(ja), *key))).otherwise(filled(other, pick(len(other), *key)))
    return chunks.where("after is not null").select(
        "doc_id",
        "chunk_index",
        genre(F.col("tags"), fixed.STORY_GENRES, fixed.STORY_GENRE_DEFAULT).alias("genre"),
        "language",
        F.concat(lead, F.lit("\n\n"), context).alias("human"),
        F.col("after").alias("gpt"),
    )


def analyst(chunks: DataFrame, seed: str = "42", share: float = 0.6) -> DataFrame:
    """(doc_id, chunk_index, task, human, gpt): entities for a share of the English chunks, sentiment for the rest and for
    chunks without entities."""
    quoted = lambda a: F.concat(F.lit("["), F.array_join(F.transform(a, lambda v: F.concat(F.lit('"'), v, F.lit('"'))), ", "), F.lit("]"))
    rows = chunks.withColumn("wanted", (roll(seed, "analyst", F.col("doc_id"), F.col("chunk_index")) < share) & (F.col("language") == "en"))
    rows = rows.withColumn("e", entities(F.when(F.col("wanted"), F.col("chunk")))).select("*", F.col("e.names").alias("names"), F.col("e.organisations").alias("orgs"))
    some = F.coalesce((F.size("names") > 0) | (F.size("orgs") > 0), F.lit(False))
    answer = F.concat(F.lit('{"角色": '), quoted(F.col("names")), F.lit(', "組織": '), quoted(F.col("orgs")), F.lit("}"))
    return rows.select(
        "doc_id",
        "chunk_index",
        F.when(some, "ner").otherwise("sentiment").alias("task"),
        F.col("chunk").alias("human"),
        F.when(some, answer).otherwise(sentiment(F.col("chunk"))).alias("gpt"),
    )


def translations(chunks: DataFrame, languages: list[str], seed: str = "42") -> DataFrame:
    """(doc_id, chunk_index, source_language, target_language, human, gpt): other languages into English, English into one of
    ``languages`` picked by hash; the answer is a marker and the chunk, to be translated later."""
    key = (seed, "translator", F.col("doc_id"), F.col("chunk_index"))
    foreign = F.col("language") != "en"
    target = F.when(foreign, F.lit("en")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in sorted(languages)]), (pick(len(languages), *key) + 1).cast("int"))
    )
    rows = chunks.withColumn("target", target)
    hint = F.when(foreign, filled(fixed.TRANSLATE_TO_EN, pick(2, seed, "hint", F.col("doc_id"), F.col("chunk_index")))).otherwise(
        filled(fixed.TRANSLATE_FROM_EN, pick(2, seed, "hint", F.col("doc_id"), F.col("chunk_index")), lang=lookup(F.col("target"), fixed.LANGUAGE_NAMES))
    )
    return rows.select(
        "doc_id",
        "chunk_index",
        F.col("language").alias("source_language"),
        F.col("target").alias("target_language"),
        F.concat(hint, F.lit("\n\n"), F.col("chunk")).alias("human"),
        F.concat(F.lit("<TRANSLATE>\n"), F.col("chunk")).alias("gpt"),
    )


def turn(conversations: str, who: str, last: bool = False) -> Column:
    """The value of the first (or last) turn of a role; null without one."""
    return F.try_element_at(F.filter(conversations, lambda t: t["from"] == who), F.lit(-1 if last else 1))["value"]


def record_text(conversations: str) -> Column:
    """The values of all turns that aren't empty, parted by blanks."""
    return F.array_join(F.filter(F.transform(conversations, lambda t: t["value"]), lambda v: v.isNotNull() & (v != "")), " ")


def dpo(records: DataFrame, key: str, conversations: str = "conversations") -> DataFrame:
    """Preference pairs: the answer as it is is rejected, the chosen one is pending; records without both turns are left out."""
    human = F.exists(conversations, lambda t: t["from"] == "human")
    gpt = F.exists(conversations, lambda t: t["from"] == "gpt")
    return records.where(human & gpt).select(
        key,
        F.coalesce(turn(conversations, "human"), F.lit("")).alias("prompt"),
        F.lit(fixed.GM_SYSTEM).alias("chosen_system"),
        F.lit(fixed.PENDING).alias("chosen"),
        F.coalesce(turn(conversations, "system"), F.lit("")).alias("rejected_system"),
        F.coalesce(turn(conversations, "gpt"), F.lit("")).alias("rejected"),
    )


def within_tokens(records: DataFrame, most: int = 900, conversations: str = "conversations") -> DataFrame:
    """Records of at most ``most`` estimated tokens, with ``tokens``."""
    return records.withColumn("tokens", token_estimate(record_text(conversations))).where(F.col("tokens") <= most)


def valid_entity(e: Column) -> Column:
    bare = strip(e)
    low = F.lower(bare)
    several = [x for x in fixed.NO_ENTITY if " " in x]
    none = ~F.contains(bare, F.lit("\n")) & (F.length(bare) > 2) & ~low.isin(fixed.NO_ENTITY)
    for x in several:
        none = none & ~F.contains(low, F.lit(x))
    demonym = (F.size(words(bare)) == 1) & bare.rlike("(?i)an$") & (F.length(bare) > 5)
    return none & ~bare.rlike(r"^\d+$") & ~bare.rlike(r"(?iU)^campaign\s+\w+$") & ~demonym


def with_answer(conversations: str, value: Column, last: bool = False) -> Column:
    """The conversation with the value of its first (or last) gpt turn replaced; turns without a role stay as they are."""
    at = F.transform(conversations, lambda t, i: F.when(t["from"] == "gpt", i))
    wanted = F.array_max(at) if last else F.array_min(at)
    return F.transform(conversations, lambda t, i: F.when(i == wanted, F.struct(t["from"].alias("from"), value.alias("value"))).otherwise(t))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _entities_of(answers: pd.Series) -> pd.Series:
    """Every text in the lists of a JSON object of lists, each once; null for anything else."""

    def one(text: str) -> list[str] | None:
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            return None
        lists = [v for v in value.values() if isinstance(v, list)] if isinstance(value, dict) else None
        return None if lists is None else list(dict.fromkeys(e for v in lists for e in v if isinstance(e, str)))

    return answers.map(one, na_action="ignore")


@F.pandas_udf(T.StringType())
def _only(answers: pd.Series, valid: pd.Series) -> pd.Series:
    """The JSON object with only the valid texts in its lists; null if the lists of entities are then empty."""

    def one(text: str | None, good) -> str | None:
        if good is None:
            return None
        good = set(good)
        value = {k: [e for e in v if isinstance(e, str) and e in good] if isinstance(v, list) else v for k, v in json.loads(text).items()}
        return json.dumps(value, ensure_ascii=False) if any(value.get(k) for k in fixed.ENTITY_LISTS) else None

    return pd.Series([one(t, g) for t, g in zip(answers, valid)], dtype=object)


def cleaned_analyst(records: DataFrame, conversations: str = "conversations") -> DataFrame:
    """Analyst records with only valid entities in their answers.

    Records of sentiment pass as they are. Of the others those are left out whose last gpt turn is missing, is no JSON object or has
    no entity left.
    """
    system = F.coalesce(turn(conversations, "system", last=True), F.lit(""))
    plain = F.contains(system, F.lit(fixed.SENTIMENT_MARKS[0])) | F.contains(system, F.lit(fixed.SENTIMENT_MARKS[1]))
    answer = turn(conversations, "gpt", last=True)
    named = records.withColumn("_plain", plain).withColumn("_all", _entities_of(F.when(~F.col("_plain"), answer)))
    kept = named.withColumn("_new", _only(answer, F.filter("_all", valid_entity)))
    out = kept.where("_plain or _new is not null")
    return out.withColumn(conversations, F.when(F.col("_plain"), F.col(conversations)).otherwise(with_answer(conversations, F.col("_new"), last=True))).drop("_plain", "_all", "_new")


def canonical_reasoning(records: DataFrame, conversations: str = "conversations") -> DataFrame:
    """Records with the keys of reasoning in one spelling in their first gpt turn; a turn that is no JSON stays as it is."""
    made = records.withColumn("_new", canonical_keys(turn(conversations, "gpt")))
    return made.withColumn(conversations, with_answer(conversations, F.col("_new"))).drop("_new")


def lore(pages: DataFrame, text: str = "text", language: str = "language", people: int = 40, factions: int = 20) -> DataFrame:
    """(kind, name): names of two words and factions in English texts, the first ones in order of code points.

    How many is the feature: they fill templates. Of each kind only distinct names are ordered.
    """

    @F.pandas_udf(T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("person", "faction")]))
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            pairs = {f"{m[1]} {m[2]}" for m in _PAIR.finditer(t) if _NO_PART.isdisjoint((m[1], m[2]))}
            rows.append((sorted(pairs), sorted({m[0] for m in _FACTION.finditer(t)})))
        return pd.DataFrame(rows, columns=["person", "faction"])

    seen = pages.where((F.col(language) == "en") & F.col(text).isNotNull()).select(found(text).alias("x"))
    kinds = [(k, n) for k, n in (("person", people), ("faction", factions))]
    parts = [seen.select(F.lit(k).alias("kind"), F.explode(f"x.{k}").alias("name")).distinct().orderBy("name").limit(n) for k, n in kinds]
    return parts[0].unionByName(parts[1])


@F.pandas_udf(T.StringType())
def canonical_keys(answers: pd.Series) -> pd.Series:
    """JSON answers with the keys of reasoning in one spelling, at every depth; anything else as it is."""

    def renamed(x):
        if isinstance(x, dict):
            return {fixed.REASONING_KEYS.get(k, k): renamed(v) for k, v in x.items()}
        return [renamed(v) for v in x] if isinstance(x, list) else x

    def one(text: str | None) -> str | None:
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            return text
        return json.dumps(renamed(value), ensure_ascii=False) if isinstance(value, (dict, list)) else text

    return answers.map(one, na_action="ignore")
