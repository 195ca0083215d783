"""Named queries over the test tables, each with the SQL it is held against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, quality
from ..functions import text as tx
from ..operators import chunk, dedup, report, shape, split, state
from . import sql
from .pages import health_records, literature_chunks, raw_pages, rpg_chunks, table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if oracle:
            _sql[f.__name__] = oracle
        return f

    return add


def _text() -> Column:
    return F.col("text")


@query(f"WITH {sql.RAW} SELECT doc_id, category, source_id, length(text) AS chars FROM raw WHERE {sql.strip('text')} <> ''")
def raw_scan_nonblank(spark, d):
    return raw_pages(spark, d).where(tx.strip(_text()) != "").select("doc_id", "category", "source_id", F.length("text").cast("long").alias("chars"))


@query(f"SELECT doc_id, {sql.wc('text')}::BIGINT AS words, length(text)::BIGINT AS chars, md5({sql.strip('text')}) AS md5, floor(length(text) / 3.5)::BIGINT AS tokens FROM documents")
def word_char_counts(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", tx.word_count(_text()).alias("words"), F.length("text").cast("long").alias("chars"), tx.md5_of(_text()).alias("md5"), tx.token_estimate(_text()).alias("tokens")
    )


@query(f"SELECT doc_id, {sql.even('text')} AS text FROM documents")
def normalize_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.even(_text()).alias("text"))


@query(f"SELECT doc_id, s.i - 1 AS pos, s.t AS sentence FROM (SELECT doc_id, unnest(list_transform({sql.sentences('text')}, lambda x, j: {{'i': j, 't': x}})) AS s FROM documents WHERE text IS NOT NULL)")
def sentence_split(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(tx.sentences(_text())).alias("p", "sentence")).select("doc_id", F.col("p").cast("long").alias("pos"), "sentence")


@query(f"SELECT doc_id, len({sql.lines('text')})::BIGINT AS lines, round({sql.single_word_lines('text')}, 6) AS single FROM documents WHERE text IS NOT NULL")
def line_stats(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(tx.lines(_text())).cast("long").alias("lines"), F.round(quality.single_word_lines(_text()), 6).alias("single"))


@query(f"SELECT doc_id, l AS language, {sql.mismatch('text', 'l')} AS mismatch FROM (SELECT doc_id, text, unnest(['en', 'ja', 'fr']) AS l FROM documents WHERE text IS NOT NULL)")
def lang_mismatch(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text", F.explode(F.array(*[F.lit(x) for x in ("en", "ja", "fr")])).alias("language"))
    return docs.select("doc_id", "language", quality.mismatch(_text(), F.col("language")).alias("mismatch"))


@query(f"SELECT rec_id, {sql.matches('output', fixed.BOILERPLATE)}::INT AS score FROM rpg_dataset WHERE output IS NOT NULL")
def boilerplate_score(spark, d):
    return table(spark, d, "rpg_dataset").where("output is not null").select("rec_id", quality.boilerplate(F.col("output")).alias("score"))


@query(f"SELECT source_id AS source, count(*) AS bad FROM rpg_dataset WHERE {sql.matches('output', fixed.BAD_SAMPLE)} > 0 GROUP BY 1")
def bad_samples(spark, d):
    return report.bad_by_source(table(spark, d, "rpg_dataset"), "output", "source_id")


@query(f"WITH {sql.RAW} SELECT doc_id, {sql.reject_reason('text', 'language')} AS reason FROM raw WHERE text IS NOT NULL")
def quality_gate_reasons(spark, d):
    return raw_pages(spark, d).where("text is not null").select("doc_id", quality.reject_reason(_text(), F.col("language")).alias("reason"))


@query(f"WITH {sql.packed(350)} SELECT doc_id, pos::BIGINT AS pos, chunk, words::BIGINT AS words FROM packed")
def chunk_pack_350(spark, d):
    docs = raw_pages(spark, d).select("doc_id", F.posexplode(chunk.packed(_text(), 350)).alias("pos", "c"))
    return docs.select("doc_id", F.col("pos").cast("long").alias("pos"), "c.chunk", "c.words")


_CHARS = f"""parts AS (SELECT doc_id, {sql.sentences('text', '.!?').replace(sql.strip('text'), 'text')} AS ss FROM documents WHERE text IS NOT NULL AND text <> ''),
cut AS (SELECT doc_id, list_reduce(ss, lambda a, s: CASE WHEN a.h <> '' AND length(a.h) + length(s) + 1 > 400 THEN {{'done': list_append(a.done, a.h), 'h': s}}
  ELSE {{'done': a.done, 'h': CASE WHEN a.h <> '' THEN a.h || ' ' || s ELSE s END}} END, {{'done': []::VARCHAR[], 'h': ''}}) AS f FROM parts),
chars AS (SELECT doc_id, list_filter(list_transform(list_append(f.done, f.h), lambda x: {sql.strip('x')}), lambda x: x <> '') AS cs FROM cut)"""


@query(f"WITH {_CHARS} SELECT doc_id, unnest(range(len(cs)))::BIGINT AS pos, unnest(cs) AS chunk FROM chars")
def chunk_chars_400(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(chunk.packed_chars(_text())).alias("pos", "chunk"))
    return docs.select("doc_id", F.col("pos").cast("long").alias("pos"), "chunk")


@query(f"WITH {_CHARS} SELECT concat_ws('_', 'ref', d.source, substr(md5(d.url), 1, 8), c.pos) AS ref_id, c.chunk FROM (SELECT doc_id, unnest(range(len(cs)))::BIGINT AS pos, unnest(cs) AS chunk FROM chars) c JOIN documents d USING (doc_id)")
def rag_ref_ids(spark, d):
    docs = table(spark, d, "documents").select("source", "url", F.posexplode(chunk.packed_chars(_text())).alias("pos", "chunk"))
    return docs.select(state.chunk_refs(docs, "source", "url", "pos").alias("ref_id"), "chunk")


@query(f"WITH {sql.sound(350)} SELECT doc_id, pos::BIGINT AS pos, chunk FROM sound")
def near_dup_greedy(spark, d):
    return chunk.sound_chunks(raw_pages(spark, d), 350).select("doc_id", F.col("pos").cast("long").alias("pos"), "chunk")


@query(f"SELECT doc_id FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY md5({sql.strip('text')}) ORDER BY doc_id) = 1")
def exact_dedup_first(spark, d):
    return dedup.exact_first(table(spark, d, "documents").where("text is not null").select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query(f"SELECT lang, count(*) AS records, count(DISTINCT md5({sql.strip('text')})) AS distinct_texts, count(*) - count(DISTINCT md5({sql.strip('text')})) AS copies FROM documents WHERE text IS NOT NULL GROUP BY lang")
def dup_count(spark, d):
    return dedup.copies(table(spark, d, "documents"), "text", "lang")


@query(f"SELECT min(rec_id) AS rec_id FROM (SELECT rec_id, md5({sql.strip(f'coalesce(output, {sql.q("")})')}) AS h FROM literature_dataset) GROUP BY h")
def record_dedup_first(spark, d):
    r = table(spark, d, "literature_dataset").select("rec_id", F.coalesce("output", F.lit("")).alias("output"))
    return dedup.exact_first(r, "output", "rec_id").select("rec_id")


_RPG = "coalesce(category, '') <> 'webnovel'"
_LIT = "category = 'webnovel'"


def _alpaca_sql(kind: str) -> str:
    n = sql.pick(10 if kind == "rpg" else 8, "'42'", f"'{kind}'", "doc_id", "chunk_index")
    if kind == "rpg":
        name = "coalesce(display_name, source_id, 'TRPG')"
        text = sql.filled(fixed.RPG_PROMPTS, n, system=sql.case_map(name, fixed.SYSTEM_NAMES, name), topic=sql.topic("chunk"))
    else:
        text = sql.filled(fixed.LITERATURE_PROMPTS, n, genre=sql.genre("tags", fixed.GENRES, fixed.GENRE_DEFAULT), derived_prompt=sql.prompt("chunk", "before"))
    return (
        f"WITH {sql.unique(350, _RPG if kind == 'rpg' else _LIT)} SELECT doc_id, chunk_index::BIGINT AS chunk_index, {text} AS instruction, '' AS input, chunk AS output, "
        f"source_id, url AS source_url, category, display_name, language, {sql.wc('chunk')}::BIGINT AS word_count FROM uniq"
    )


@query(_alpaca_sql("rpg"))
def build_alpaca_rpg(spark, d):
    return shape.alpaca(rpg_chunks(spark, d), literature=False).drop("tags")


@query(_alpaca_sql("literature"))
def build_alpaca_literature(spark, d):
    return shape.alpaca(literature_chunks(spark, d), literature=True).drop("tags")


@query(
    f"""WITH {sql.unique(350, _RPG)}, r AS (SELECT source_id, language, {sql.wc('chunk')}::BIGINT AS w FROM uniq)
SELECT CASE grouping(source_id, language) WHEN 3 THEN 'all' WHEN 1 THEN 'source' ELSE 'language' END AS kind,
  CASE grouping(source_id, language) WHEN 1 THEN source_id WHEN 2 THEN language END AS name, count(*) AS records, sum(w)::BIGINT AS total_words, round(avg(w), 1) AS avg_words, min(w) AS min_words, max(w) AS max_words
FROM r GROUP BY GROUPING SETS ((), (source_id), (language))"""
)
def build_stats(spark, d):
    r = rpg_chunks(spark, d).select("source_id", "language", tx.word_count(F.col("chunk")).alias("w"))
    return report.dataset_stats(r, "w", "source_id", "language")


@query(f"SELECT doc_id, {sql.topic('text')} AS topic, {sql.prompt('text', 'title')} AS prompt FROM documents WHERE text IS NOT NULL AND title IS NOT NULL")
def topic_and_prompt(spark, d):
    docs = table(spark, d, "documents").where("text is not null and title is not null")
    return docs.select("doc_id", shape.topic(_text()).alias("topic"), shape.derived_prompt(_text(), F.col("title")).alias("prompt"))


@query(
    f"SELECT source_id, {sql.genre('tags', fixed.GENRES, fixed.GENRE_DEFAULT)} AS genre, {sql.genre('tags', fixed.STORY_GENRES, fixed.STORY_GENRE_DEFAULT)} AS story_genre, "
    f"{sql.case_map('display_name', fixed.SYSTEM_NAMES, 'display_name')} AS system_name, {sql.case_map('language', fixed.LANGUAGE_NAMES, 'language')} AS language_name FROM crawl_source"
)
def lookup_defaults(spark, d):
    tags = F.col("tags")
    return table(spark, d, "crawl_source").select(
        "source_id",
        shape.genre(tags).alias("genre"),
        shape.genre(tags, fixed.STORY_GENRES, fixed.STORY_GENRE_DEFAULT).alias("story_genre"),
        tx.lookup(F.col("display_name"), fixed.SYSTEM_NAMES).alias("system_name"),
        tx.lookup(F.col("language"), fixed.LANGUAGE_NAMES).alias("language_name"),
    )


def _story_sql(more: str = "") -> str:
    s = sql.sentences("chunk")
    tail = sql.strip(f"array_to_string({s}[greatest(len({s}) - 1, 1):], ' ')")
    context = f"(CASE WHEN {sql.wc(tail)} < 10 THEN {sql.strip('right(chunk, 300)')} ELSE {tail} END)"
    key = ("'42'", "'story'", "doc_id", "chunk_index")
    lead = f"(CASE WHEN language = 'ja' THEN {sql.filled(fixed.CONTINUATION_PROMPTS_JA, sql.pick(3, *key))} ELSE {sql.filled(fixed.CONTINUATION_PROMPTS, sql.pick(5, *key))} END)"
    return (
        f"WITH {sql.unique(400, 'category IN (' + ', '.join(map(sql.q, fixed.STORY_CATEGORIES)) + ')')} SELECT doc_id, chunk_index::BIGINT AS chunk_index, "
        f"{sql.genre('tags', fixed.STORY_GENRES, fixed.STORY_GENRE_DEFAULT)} AS genre, {lead} || chr(10) || chr(10) || {context} AS human, after AS gpt{more} FROM uniq WHERE after IS NOT NULL"
    )


def _stories(spark, d):
    pages = raw_pages(spark, d).where(F.col("category").isin(fixed.STORY_CATEGORIES))
    return shape.story_pairs(shape.unique_chunks(pages, 400))


@query(_story_sql())
def storyteller_pairs(spark, d):
    return _stories(spark, d).drop("language")


def _turns(records: DataFrame, conversations: str = "conversations") -> DataFrame:
    """(turn, who, value): the turns of conversations, one row each."""
    return records.select(F.posexplode(conversations).alias("turn", "t")).select(F.col("turn").cast("long").alias("turn"), F.col("t.from").alias("who"), F.col("t.value").alias("value"))


def _turns_sql(records: str, system: str) -> str:
    return (
        f"WITH recs AS ({records}) SELECT 0::BIGINT AS turn, 'system' AS who, {system} AS value FROM recs UNION ALL SELECT 1, 'human', human FROM recs UNION ALL SELECT 2, 'gpt', gpt FROM recs"
    )


@query(_turns_sql(_story_sql(", language"), f"replace(CASE WHEN language = 'ja' THEN {sql.q(fixed.STORY_SYSTEM_JA)} ELSE {sql.q(fixed.STORY_SYSTEM)} END, '{{genre}}', genre)"))
def storyteller_turns(spark, d):
    """The conversations of the storyteller set, turn by turn."""
    return _turns(shape.as_stories(_stories(spark, d)))


@query(
    f"WITH recs AS ({_alpaca_sql('rpg').replace('display_name, language,', 'display_name, tags, language,')}) SELECT instruction, input, output, coalesce(source_id, '') AS source_id, coalesce(source_url, '') AS source_url, "
    "coalesce(category, 'trpg') AS category, coalesce(display_name, '') AS display_name, coalesce(array_to_string(tags, '|'), '') AS tags, coalesce(language, 'en') AS language, chunk_index, word_count FROM recs"
)
def alpaca_records(spark, d):
    """Instruction records with their metadata as written, its fields side by side."""
    made = shape.as_alpaca(shape.alpaca(rpg_chunks(spark, d), literature=False))
    return made.select("instruction", "input", "output", "metadata.*").withColumn("tags", F.array_join("tags", "|"))


@query(f"SELECT rec_id, {sql.sentiment('output')} AS label FROM literature_dataset WHERE output IS NOT NULL")
def sentiment_label(spark, d):
    return table(spark, d, "literature_dataset").where("output is not null").select("rec_id", shape.sentiment(F.col("output")).alias("label"))


@query()
def ner_entities(spark, d):
    """Names and organisations of English documents; overlapping, case-blind matches are held against a model in tests."""
    docs = table(spark, d, "documents").where("lang = 'en' and text is not null")
    return docs.withColumn("e", shape.entities("text")).select("doc_id", "e.names", "e.organisations")


@query()
def analyst_records(spark, d):
    """Entity and sentiment tasks over all chunks of at most 500 words; its parts are checked one by one."""
    return shape.analyst(shape.unique_chunks(raw_pages(spark, d), 500, prefix="analyst:"))


_LANGS = ["de", "es", "fr", "ja", "zh"]


def _translator_sql() -> str:
    key = ("'42'", "'translator'", "doc_id", "chunk_index")
    hint_key = ("'42'", "'hint'", "doc_id", "chunk_index")
    target = f"(CASE WHEN language <> 'en' THEN 'en' ELSE ({sql.in_list(_LANGS)})[{sql.pick(5, *key)} + 1] END)"
    hint = (
        f"(CASE WHEN language <> 'en' THEN {sql.filled(fixed.TRANSLATE_TO_EN, sql.pick(2, *hint_key))} "
        f"ELSE {sql.filled(fixed.TRANSLATE_FROM_EN, sql.pick(2, *hint_key), lang=sql.case_map(target, fixed.LANGUAGE_NAMES, target))} END)"
    )
    return (
        f"WITH {sql.unique(200, 'true', 'trans:')} SELECT doc_id, chunk_index::BIGINT AS chunk_index, language AS source_language, {target} AS target_language, "
        f"{hint} || chr(10) || chr(10) || chunk AS human, '<TRANSLATE>' || chr(10) || chunk AS gpt FROM uniq"
    )


@query(_translator_sql())
def translator_records(spark, d):
    return shape.translations(shape.unique_chunks(raw_pages(spark, d), 200, prefix="trans:"), _LANGS)


_NAME_OF = lambda c: sql.case_map(c, fixed.LANGUAGE_NAMES, c)


@query(_turns_sql(_translator_sql(), f"replace(replace({sql.q(fixed.TRANSLATOR_SYSTEM)}, '{{src_lang}}', {_NAME_OF('source_language')}), '{{tgt_lang}}', {_NAME_OF('target_language')})"))
def translator_turns(spark, d):
    """The conversations of the translator set, turn by turn."""
    return _turns(shape.as_translations(translator_records(spark, d)))


_NOT = sql.in_list(list(dict.fromkeys(fixed.NOT_NAMES + fixed.NUMBER_WORDS)))


@query()
def lore_names(spark, d):
    """Names of two words in all English texts; no SQL, as DuckDB's word ends know ASCII letters only."""
    return _names(table(spark, d, "documents").where("lang = 'en' and text is not null"))


@query()
def lore_harvest(spark, d):
    """The first 40 names and 20 factions of English texts, that many being the feature; no SQL for the same reason."""
    return shape.lore(table(spark, d, "documents"), language="lang")


def _names(docs):
    # a name ends where no letter, digit or underscore of any script is beside it
    whole = r"(?<![\p{L}\p{N}_])[A-Z][a-z]{2,15}[ ]+[A-Z][a-z]{2,15}(?![\p{L}\p{N}_])"
    found = docs.select(F.explode(F.regexp_extract_all(_text(), F.lit(whole), F.lit(0))).alias("n"))
    name = F.regexp_replace("n", " +", " ")
    no = F.array(*[F.lit(w) for w in dict.fromkeys(fixed.NOT_NAMES + fixed.NUMBER_WORDS)])
    return found.where(~F.arrays_overlap(F.split(name, " "), no)).select(name.alias("name")).distinct()


def _valid_sql(x: str) -> str:
    bare = sql.strip(x)
    several = " AND ".join(f"NOT contains(lower({bare}), {sql.q(e)})" for e in fixed.NO_ENTITY if " " in e)
    return (
        f"(NOT contains({bare}, chr(10)) AND length({bare}) > 2 AND NOT list_contains({sql.in_list(fixed.NO_ENTITY)}, lower({bare})) AND {several} AND NOT regexp_matches({bare}, '^\\d+$') "
        f"AND NOT regexp_matches({bare}, '(?i)^campaign\\s+\\w+$') AND NOT ({sql.wc(bare)} = 1 AND regexp_matches({bare}, '(?i)an$') AND length({bare}) > 5))"
    )


def _analyst_records(spark, d) -> DataFrame:
    """A conversation for each document: entities are its title, source, category and url, or a label for texts of odd ids."""
    docs = table(spark, d, "documents")
    names = F.to_json(F.struct(F.array_compact(F.array("title", "category")).alias(fixed.ENTITY_LISTS[0]), F.array_compact(F.array("source")).alias(fixed.ENTITY_LISTS[1])))
    odd = F.col("doc_id") % 2 == 1
    system = F.when(odd, fixed.SENTIMENT_SYSTEM).otherwise(fixed.NER_SYSTEM)
    return docs.select("doc_id", shape.sharegpt(system, F.coalesce("title", F.lit("")), F.when(odd, fixed.SENTIMENTS["neutral"]).otherwise(names)).alias("conversations"))


_ENTITIES = lambda *c: f"list_filter([{', '.join(c)}], lambda e: e IS NOT NULL AND {_valid_sql('e')})"


@query(
    f"""WITH e AS (SELECT doc_id, {_ENTITIES('title', 'category')} AS a, {_ENTITIES('source')} AS b FROM documents WHERE doc_id % 2 = 0)
SELECT doc_id, NULL AS label, array_to_string(a, '|') AS names, array_to_string(b, '|') AS organisations FROM e WHERE len(a) + len(b) > 0 UNION ALL SELECT doc_id, {sql.q(fixed.SENTIMENTS['neutral'])}, NULL, NULL FROM documents WHERE doc_id % 2 = 1"""
)
def analyst_clean(spark, d):
    """Analyst records with invalid entities taken out and empty records dropped; records of sentiment pass."""
    made = shape.cleaned_analyst(_analyst_records(spark, d))
    answer = shape.turn("conversations", "gpt")
    lists = F.from_json(answer, f"`{fixed.ENTITY_LISTS[0]}` array<string>, `{fixed.ENTITY_LISTS[1]}` array<string>")
    named = answer.startswith("{")
    return made.select(
        "doc_id", F.when(~named, answer).alias("label"), *[F.when(named, F.array_join(lists[x], "|")).alias(n) for x, n in zip(fixed.ENTITY_LISTS, ("names", "organisations"))]
    )


_TEXT = "array_to_string(list_filter(list_transform(conversations, lambda t: t.value), lambda v: v IS NOT NULL AND v <> ''), ' ')"


@query(f"SELECT rec_id, floor(length({_TEXT}) / 3.5)::BIGINT AS tokens FROM lora_translator WHERE floor(length({_TEXT}) / 3.5) <= 900")
def token_filter(spark, d):
    return shape.within_tokens(table(spark, d, "lora_translator")).select("rec_id", "tokens")


@query(
    f"""WITH t AS (SELECT list_sort(list(floor(length({_TEXT}) / 3.5)::BIGINT)) AS s FROM lora_translator WHERE conversations IS NOT NULL)
SELECT s[least(floor(len(s) * 50 / 100)::BIGINT, len(s) - 1) + 1] AS p50, s[least(floor(len(s) * 95 / 100)::BIGINT, len(s) - 1) + 1] AS p95, s[len(s)] AS most FROM t"""
)
def token_percentiles(spark, d):
    t = table(spark, d, "lora_translator").where("conversations is not null").select(tx.token_estimate(shape.record_text("conversations")).alias("tokens"))
    return report.nearest_rank(t, "tokens", [], (50, 95)).select("p50", "p95", "most")


_FIRST = lambda who: f"coalesce(list_filter(conversations, lambda t: t[\'from\'] = '{who}')[1].value, '')"


@query(
    f"""SELECT rec_id, {_FIRST('human')} AS prompt, {sql.q(fixed.GM_SYSTEM)} AS chosen_system, {sql.q(fixed.PENDING)} AS chosen, {_FIRST('system')} AS rejected_system, {_FIRST('gpt')} AS rejected
FROM lora_storyteller WHERE len(list_filter(conversations, lambda t: t['from'] = 'human')) > 0 AND len(list_filter(conversations, lambda t: t['from'] = 'gpt')) > 0"""
)
def dpo_pairs(spark, d):
    return shape.dpo(table(spark, d, "lora_storyteller"), "rec_id")


@query(
    f"""WITH p AS (SELECT {_FIRST('system')} AS s, {_FIRST('gpt')} AS g FROM lora_storyteller WHERE len(list_filter(conversations, lambda t: t['from'] = 'human')) > 0 AND len(list_filter(conversations, lambda t: t['from'] = 'gpt')) > 0)
SELECT 'chosen' AS answer, 0::BIGINT AS turn, 'system' AS who, {sql.q(fixed.GM_SYSTEM)} AS value FROM p UNION ALL SELECT 'chosen', 1, 'gpt', {sql.q(fixed.PENDING)} FROM p
UNION ALL SELECT 'rejected', 0, 'system', s FROM p UNION ALL SELECT 'rejected', 1, 'gpt', g FROM p"""
)
def dpo_turns(spark, d):
    """Both answers of the preference pairs, turn by turn."""
    made = shape.as_dpo(dpo_pairs(spark, d))
    parts = [_turns(made, c).select(F.lit(c).alias("answer"), "*") for c in ("chosen", "rejected")]
    return parts[0].unionByName(parts[1])


@query(f"SELECT rec_id FROM lora_storyteller_dpo WHERE len(list_filter(chosen, lambda t: t['from'] = 'gpt' AND contains(coalesce(t.value, ''), {sql.q(fixed.PENDING)}))) > 0")
def dpo_pending(spark, d):
    return table(spark, d, "lora_storyteller_dpo").where(report.is_pending("chosen")).select("rec_id")


_OLD, _NEW = list(fixed.REASONING_KEYS), list(fixed.REASONING_KEYS.values())


@query(
    f"""SELECT rec_id, CASE WHEN rec_id % 3 = 0 OR source_id IS NULL THEN coalesce(source_id, '') ELSE '{{"{_NEW[0]}": ' || rec_id || ', "x": [{{"{_NEW[1]}": ' || to_json(source_id) || '}}]}}' END AS value FROM lora_storyteller"""
)
def reasoning_keys(spark, d):
    """Conversations whose answer is JSON with two keys in an old spelling, at two depths, or plain text: with the keys in one spelling."""
    rows = table(spark, d, "lora_storyteller")
    answer = F.concat(F.lit(f'{{"{_OLD[0]}": '), F.col("rec_id").cast("string"), F.lit(f', "x": [{{"{_OLD[1]}": "'), "source_id", F.lit('"}]}'))
    answer = F.when((F.col("rec_id") % 3 == 0) | F.col("source_id").isNull(), F.coalesce("source_id", F.lit(""))).otherwise(answer)
    made = rows.select("rec_id", shape.sharegpt(F.lit(""), F.lit(""), answer).alias("conversations"))
    return shape.canonical_reasoning(made).select("rec_id", shape.turn("conversations", "gpt").alias("value"))


@query(
    """SELECT rec_id, CASE WHEN list_contains(json_keys(j), 'conversations') THEN 'sharegpt' WHEN list_contains(json_keys(j), 'instruction') AND list_contains(json_keys(j), 'output') THEN 'alpaca'
  WHEN list_contains(json_keys(j), 'prompt') AND list_contains(json_keys(j), 'chosen') THEN 'dpo' ELSE 'unknown' END AS format
FROM (SELECT rec_id, json_object(CASE rec_id % 3 WHEN 0 THEN 'conversations' WHEN 1 THEN 'instruction' ELSE 'prompt' END, 1, CASE rec_id % 4 WHEN 0 THEN 'output' WHEN 1 THEN 'chosen' ELSE 'x' END, 2) AS j FROM rpg_dataset)"""
)
def format_detect(spark, d):
    """Formats of lines of JSON made from ids, of every kind."""
    a = F.element_at(F.array(F.lit("conversations"), F.lit("instruction"), F.lit("prompt")), (F.col("rec_id") % 3 + 1).cast("int"))
    b = F.element_at(F.array(F.lit("output"), F.lit("chosen"), F.lit("x"), F.lit("x")), (F.col("rec_id") % 4 + 1).cast("int"))
    line = F.concat(F.lit('{"'), a, F.lit('": 1, "'), b, F.lit('": 2}'))
    return table(spark, d, "rpg_dataset").select("rec_id", report.record_format(line).alias("format"))


@query(
    f"""SELECT rec_id, CASE WHEN {sql.strip('l')} = '' THEN 'blank' WHEN NOT json_valid(l) THEN 'bad_json' WHEN {sql.strip('o')} = '' THEN 'blank_output' END AS error
FROM (SELECT rec_id, coalesce(output, '') AS o, CASE WHEN output IS NULL THEN ' ' WHEN batch_id = 2 THEN '{{"instruction": ' ELSE '{{"instruction": 1, "output": ' || to_json(output) || ', "metadata": {{}}}}' END AS l FROM rpg_dataset)"""
)
def jsonl_errors(spark, d):
    """Errors of lines of JSON made of records: blank lines, cut lines, blank outputs."""
    r = table(spark, d, "rpg_dataset")
    whole = F.concat(F.lit('{"instruction": 1, "output": '), F.get(F.array(F.regexp_replace(F.to_json(F.struct(F.col("output").alias("o"))), r'^\{"o":|\}\z', "")), F.lit(0)), F.lit(', "metadata": {}}'))
    line = F.when(F.col("output").isNull(), " ").when(F.col("batch_id") == 2, '{"instruction": ').otherwise(whole)
    return report.record_errors(r.select("rec_id", line.alias("line"))).select("rec_id", "error")


_GPT = "array_to_string(list_transform(list_filter(conversations, lambda t: t['from'] = 'gpt'), lambda t: coalesce(t.value, '')), ' ')"
_HEALTH = f"""recs AS (
SELECT 'rpg_dataset.jsonl' AS file, 'alpaca' AS format, coalesce(output, '') AS text, source_id AS source, coalesce(language, 'en') AS language, false AS pending, instruction IS NOT NULL AND output IS NOT NULL AS valid FROM rpg_dataset
UNION ALL SELECT 'literature_dataset.jsonl', 'alpaca', coalesce(output, ''), metadata.source_id, coalesce(metadata.language, 'en'), false, instruction IS NOT NULL AND output IS NOT NULL FROM literature_dataset
UNION ALL SELECT 'lora_storyteller.jsonl', 'sharegpt', coalesce({_GPT}, ''), source_id, 'unknown', false, coalesce(len(conversations) > 0, false) FROM lora_storyteller
UNION ALL SELECT 'lora_translator.jsonl', 'sharegpt', coalesce({_GPT}, ''), source_id, coalesce(language, 'unknown'), false, coalesce(len(conversations) > 0, false) FROM lora_translator
UNION ALL SELECT 'lora_storyteller_dpo.jsonl', 'dpo', coalesce(prompt, '') || ' ' || coalesce(list_filter(chosen, lambda t: t['from'] = 'gpt')[1].value, ''), NULL, 'unknown', coalesce(len(list_filter(chosen, lambda t: t['from'] = 'gpt' AND contains(coalesce(t.value, ''), {sql.q(fixed.PENDING)}))) > 0, false), prompt IS NOT NULL FROM lora_storyteller_dpo),
metrics AS (SELECT file, min(format) AS format, count(*) AS total_lines, count(*) FILTER (valid) AS valid_records, count(*) FILTER (NOT valid) AS format_errors,
  count(*) FILTER (valid AND {sql.matches('text', fixed.BAD_SAMPLE)} > 0) AS bad_samples, count(*) FILTER (valid) - count(DISTINCT CASE WHEN valid THEN md5({sql.strip('text')}) END) AS exact_dups,
  count(*) FILTER (valid AND pending) AS needs_generation, list_sort(list({sql.wc('text')}::BIGINT) FILTER (valid)) AS s FROM recs GROUP BY file),
ranked AS (SELECT * EXCLUDE (s), s[1] AS word_count_min, s[least(floor(len(s) * 25 / 100)::BIGINT, len(s) - 1) + 1] AS word_count_p25, s[least(floor(len(s) * 50 / 100)::BIGINT, len(s) - 1) + 1] AS word_count_median,
  s[least(floor(len(s) * 75 / 100)::BIGINT, len(s) - 1) + 1] AS word_count_p75, s[len(s)] AS word_count_max FROM metrics),
rated AS (SELECT *, bad_samples::DOUBLE / nullif(valid_records, 0) AS bad_rate, exact_dups::DOUBLE / nullif(valid_records, 0) AS dup_rate FROM ranked),
stat AS (SELECT *, CASE WHEN format = 'dpo' AND needs_generation > 0 AND needs_generation = valid_records THEN {sql.q(fixed.STATUS['waiting'])} WHEN valid_records = 0 THEN {sql.q(fixed.STATUS['empty'])}
  WHEN bad_rate > 0.10 OR dup_rate > 0.20 THEN {sql.q(fixed.STATUS['danger'])} WHEN bad_rate > 0.03 OR dup_rate > 0.05 OR valid_records < 50 OR coalesce(word_count_median, 0) < 20 THEN {sql.q(fixed.STATUS['warn'])} ELSE {sql.q(fixed.STATUS['healthy'])} END AS status FROM rated)"""


@query(f"WITH {_HEALTH} SELECT * FROM ranked")
def file_health(spark, d):
    return report.file_metrics(health_records(spark, d))


_PARTS = (
    "r AS (SELECT file, coalesce(source, 'unknown') AS source, coalesce(language, 'unknown') AS language, CASE WHEN " + sql.matches("text", fixed.BAD_SAMPLE) + " > 0 THEN 1 ELSE 0 END AS bad FROM recs WHERE valid), "
    "parts AS (SELECT file, 'source' AS kind, source AS name, count(*) AS records, sum(bad)::BIGINT AS bad FROM r GROUP BY ALL UNION ALL SELECT file, 'language', language, count(*), sum(bad)::BIGINT FROM r GROUP BY ALL)"
)


@query(f"WITH {_HEALTH}, {_PARTS} SELECT * FROM parts")
def health_breakdown(spark, d):
    """Records and bad samples of each file by source and by language."""
    return report.breakdown(report.counted_texts(health_records(spark, d)))


@query(f"WITH {_HEALTH}, {_PARTS} SELECT * FROM (SELECT file, name AS source, bad, row_number() OVER (PARTITION BY file ORDER BY bad DESC, name) AS place FROM parts WHERE kind = 'source' AND bad > 0) WHERE place <= 3")
def health_worst_sources(spark, d):
    """Of each file the three sources with the most bad samples."""
    return report.worst_sources(report.breakdown(report.counted_texts(health_records(spark, d))))


@query(f"WITH {_HEALTH} SELECT file, round(bad_rate, 6) AS bad_rate, round(dup_rate, 6) AS dup_rate, status FROM stat")
def health_status(spark, d):
    s = report.health_status(report.file_metrics(health_records(spark, d)))
    return s.select("file", F.round("bad_rate", 6).alias("bad_rate"), F.round("dup_rate", 6).alias("dup_rate"), "status")


@query(
    f"""WITH {_HEALTH} SELECT count(*) AS files, sum(valid_records)::BIGINT AS records, sum(bad_samples)::BIGINT AS bad, count(*) FILTER (status = {sql.q(fixed.STATUS['healthy'])}) AS healthy,
count(*) FILTER (status = {sql.q(fixed.STATUS['warn'])}) AS warned, count(*) FILTER (status IN ({sql.q(fixed.STATUS['danger'])}, {sql.q(fixed.STATUS['empty'])})) AS in_danger, count(*) FILTER (status = {sql.q(fixed.STATUS['waiting'])}) AS waiting FROM stat"""
)
def health_overall(spark, d):
    return report.overall(report.health_status(report.file_metrics(health_records(spark, d))))


@query(
    f"""WITH {_HEALTH} SELECT file, unnest(list_filter([CASE WHEN valid_records = 0 THEN 'check_crawl' END, CASE WHEN bad_rate > 0.10 THEN 'drop_sources' WHEN bad_rate > 0.03 THEN 'check_sources' END,
CASE WHEN dup_rate > 0.05 THEN 'dedup' END, CASE WHEN valid_records > 0 AND valid_records < 50 THEN 'more_records' END], lambda x: x IS NOT NULL)) AS suggestion FROM stat"""
)
def health_suggestions(spark, d):
    return report.suggestions(report.health_status(report.file_metrics(health_records(spark, d))))


_SNAP = """n AS (SELECT source_id, count(*)::DOUBLE AS records, count(output)::DOUBLE AS filled FROM rpg_dataset WHERE source_id IS NOT NULL GROUP BY 1),
o AS (SELECT source_id, count(*)::DOUBLE AS records, count(output)::DOUBLE AS filled FROM rpg_dataset WHERE source_id IS NOT NULL AND batch_id <= 4 GROUP BY 1),
a AS (UNPIVOT n ON records, filled INTO NAME value VALUE new_value), b AS (UNPIVOT o ON records, filled INTO NAME value VALUE old_value)"""


@query(f"WITH {_SNAP} SELECT a.source_id, a.value, old_value, new_value - old_value AS change, CASE WHEN new_value < old_value THEN '↓' WHEN new_value > old_value THEN '↑' WHEN new_value = old_value THEN '→' END AS trend FROM a LEFT JOIN b ON a.source_id = b.source_id AND a.value = b.value")
def health_delta(spark, d):
    """What changed per source between the first batches and all."""
    r = table(spark, d, "rpg_dataset").where("source_id is not null")
    snap = lambda x: x.groupBy("source_id").agg(F.count("*").alias("records"), F.count("output").alias("filled"))
    return report.delta(snap(r), snap(r.where("batch_id <= 4")), "source_id", "records", "filled")


@query("SELECT rec_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || rec_id), rec_id) <= greatest(1, floor(count(*) OVER () * 0.9)) THEN 'train' ELSE 'val' END AS part FROM rpg_dataset")
def train_val_split(spark, d):
    return split.train_val(table(spark, d, "rpg_dataset").select("rec_id"), "rec_id")


@query("SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 25")
def sample_n(spark, d):
    return split.sample(table(spark, d, "documents").select("doc_id"), "doc_id", 25)


_HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), '')"


@query(f"SELECT {_HOST} AS host, count(*) AS urls FROM raw_page WHERE url IS NOT NULL GROUP BY 1")
def host_counts(spark, d):
    return table(spark, d, "raw_page").where("url is not null").groupBy(state.host(F.col("url")).alias("host")).agg(F.count("*").alias("urls"))


@query(f"SELECT url, {_HOST} AS host, row_number() OVER (PARTITION BY {_HOST} ORDER BY url) AS turn FROM (SELECT DISTINCT url FROM raw_page WHERE url IS NOT NULL)")
def host_interleave(spark, d):
    return state.interleaved(table(spark, d, "raw_page").where("url is not null").select("url").distinct(), "url", "url")


_PATH = "regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g')"
_SAFE = f"regexp_replace(CASE WHEN {_PATH} = '' THEN replace({_HOST}, '.', '_') ELSE replace({_PATH}, '/', '_') END, '[^\\pL\\pM\\pN_\\-]', '_', 'g')"


@query(
    f"""SELECT DISTINCT url, replace(split_part(replace({_HOST}, 'www.', ''), '.', 1), '-', '_') AS source_id, CASE WHEN length({_SAFE}) > 80 THEN substr({_SAFE}, 1, 72) || '_' || substr(md5(url), 1, 7) ELSE {_SAFE} END AS name,
CASE WHEN contains({_HOST}, 'fandom.com') THEN 'https://' || {_HOST} || '/wiki/' WHEN contains({_HOST}, 'lexicanum.com') THEN 'https://' || {_HOST} || '/wiki/Main_Page' WHEN contains({_HOST}, 'royalroad.com') THEN 'https://www.royalroad.com/'
WHEN contains({_HOST}, 'archiveofourown.org') THEN 'https://archiveofourown.org/' WHEN contains({_HOST}, 'syosetu.com') THEN 'https://yomou.syosetu.com/' ELSE 'https://' || {_HOST} || '/' END AS referer FROM raw_page WHERE url IS NOT NULL"""
)
def url_names(spark, d):
    u = F.col("url")
    pages = table(spark, d, "raw_page").where("url is not null").select("url").distinct()
    return pages.select("url", state.source_id_of(u).alias("source_id"), state.file_name(u).alias("name"), state.referer(u).alias("referer"))


@query("SELECT page_id, max(received_at) AS received_at, arg_max(checksum_md5, (received_at, coalesce(checksum_md5, ''))) AS checksum FROM raw_page WHERE page_id IS NOT NULL AND received_at IS NOT NULL GROUP BY page_id")
def state_upsert_latest(spark, d):
    pages = table(spark, d, "raw_page").where("received_at is not null").select("page_id", "received_at", F.coalesce("checksum_md5", F.lit("")).alias("c"), F.col("checksum_md5").alias("checksum"))
    return state.latest(pages, "page_id", ["received_at", "c"], "received_at", "checksum")


_VISITS = """v AS (SELECT page_id, url, scraped_at, http_status, word_count AS words, checksum_md5 AS checksum FROM raw_page WHERE url IS NOT NULL AND scraped_at IS NOT NULL),
f AS (SELECT url, min(scraped_at) AS first_at FROM v GROUP BY url), s AS (SELECT v.url, max(CASE WHEN http_status = 200 THEN 'ok' ELSE 'failed' END) AS status, max(checksum) AS checksum FROM v JOIN f ON v.url = f.url AND scraped_at = first_at GROUP BY v.url),
n AS (SELECT v.* FROM v JOIN f ON v.url = f.url WHERE scraped_at > first_at)"""


@query(
    f"""WITH {_VISITS} SELECT n.page_id, n.scraped_at, CASE WHEN http_status = 304 THEN 'unchanged' WHEN coalesce(words, 0) = 0 THEN 'failed' WHEN s.status = 'ok' AND coalesce(n.checksum = s.checksum, false) THEN 'unchanged' WHEN s.status = 'ok' THEN 'updated' ELSE 'stored' END AS outcome FROM n LEFT JOIN s ON n.url = s.url"""
)
def crawl_decision(spark, d):
    """Later visits of pages against the state their first visit left."""
    p = table(spark, d, "raw_page").where("url is not null and scraped_at is not null")
    v = p.select("page_id", "url", "scraped_at", "http_status", F.col("word_count").alias("words"), F.col("checksum_md5").alias("checksum"))
    first = v.groupBy("url").agg(F.min("scraped_at").alias("first_at"))
    j = v.join(first, "url")
    ok = F.max(F.when(F.col("http_status") == 200, "ok").otherwise("failed"))
    s = j.where("scraped_at = first_at").groupBy("url").agg(ok.alias("status"), F.max("checksum").alias("checksum"))
    return state.crawl_decision(j.where("scraped_at > first_at").drop("first_at"), s).select("page_id", "scraped_at", "outcome")


@query(
    """WITH f AS (SELECT page_id, min(output_file) AS path, min(checksum_md5) AS md5, min(category) AS type_key, min(http_status) AS st FROM raw_page WHERE output_file IS NOT NULL GROUP BY page_id)
SELECT path, CASE WHEN md5 IS NOT NULL AND page_id % 3 = 0 THEN 'done' WHEN type_key IS NULL OR type_key = 'webnovel' THEN 'no_target' WHEN coalesce(st = 200, false) AND page_id % 5 = 0 THEN 'exists' ELSE 'transfer' END AS outcome FROM f"""
)
def transfer_decision(spark, d):
    """Files of raw pages: some transferred before, some without a target, some in the way of others."""
    p = table(spark, d, "raw_page").where("output_file is not null").groupBy("page_id").agg(
        F.min("output_file").alias("path"), F.min("checksum_md5").alias("md5"), F.min("category").alias("type_key"), F.min("http_status").alias("st")
    )
    files = p.select(F.concat_ws("#", "path", "page_id").alias("path"), "type_key", "md5", (F.coalesce(F.col("st") == 200, F.lit(False)) & (F.col("page_id") % 5 == 0)).alias("exists"), "page_id")
    done = files.where("page_id % 3 = 0 and md5 is not null")
    targets = files.where("type_key <> 'webnovel'").select("type_key").distinct().withColumn("target", F.concat(F.lit("/models/"), "type_key"))
    out = state.transfer_decision(files, done, targets)
    return out.select(F.regexp_replace("path", "#[0-9]+$", "").alias("path"), "outcome")


@query("SELECT DISTINCT regexp_replace(d.url, '/+$', '') AS url FROM documents d WHERE d.url IS NOT NULL AND regexp_replace(d.url, '/+$', '') NOT IN (SELECT regexp_replace(url, '/+$', '') FROM raw_page WHERE url IS NOT NULL)")
def known_url_merge(spark, d):
    return dedup.new_links(table(spark, d, "documents"), table(spark, d, "raw_page"))


@query("SELECT DISTINCT unnest(tags) AS tag FROM crawl_source")
def tags_distinct(spark, d):
    return table(spark, d, "crawl_source").select(F.explode("tags").alias("tag")).distinct()


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM raw_page p WHERE p.url = d.url AND p.http_status = 200)")
def anti_join_state(spark, d):
    done = table(spark, d, "raw_page").where("http_status = 200 and url is not null").select("url").distinct()
    return table(spark, d, "documents").select("doc_id", "url").join(done, "url", "left_anti").select("doc_id")


@query("SELECT r.rec_id, p.page_id, p.http_status FROM rpg_dataset r JOIN raw_page p ON r.metadata.source_url = p.url")
def sidecar_join(spark, d):
    r = table(spark, d, "rpg_dataset").select("rec_id", F.col("metadata.source_url").alias("url"))
    return r.join(table(spark, d, "raw_page").select("url", "page_id", "http_status"), "url").select("rec_id", "page_id", "http_status")


@query(
    """SELECT c.source_id, coalesce(u.url, c.sample_strategy, 'none') AS origin FROM crawl_source c LEFT JOIN (SELECT source_id, unnest(urls) AS url FROM crawl_source) u USING (source_id)"""
)
def resolve_urls(spark, d):
    """A source's own addresses, else its sampling strategy."""
    c = table(spark, d, "crawl_source").select("source_id", "sample_strategy", F.explode_outer("urls").alias("url"))
    return c.select("source_id", F.coalesce("url", "sample_strategy", F.lit("none")).alias("origin"))


@query(
    """SELECT 'rpg' AS part, count(*) AS kept FROM rpg_dataset WHERE output IS NOT NULL UNION ALL SELECT 'rpg_blank', count(*) FROM rpg_dataset WHERE output IS NULL
UNION ALL SELECT 'pending', count(*) FROM lora_storyteller_dpo WHERE len(list_filter(chosen, lambda t: t['from'] = 'gpt' AND contains(coalesce(t.value, ''), '<NEEDS_GM_RESPONSE>'))) > 0"""
)
def post_counters(spark, d):
    r = table(spark, d, "rpg_dataset").agg(F.count("output").alias("rpg"), F.count_if(F.col("output").isNull()).alias("rpg_blank"))
    p = table(spark, d, "lora_storyteller_dpo").agg(F.count_if(report.is_pending("chosen")).alias("pending"))
    return r.select(F.explode(F.create_map(F.lit("rpg"), "rpg", F.lit("rpg_blank"), "rpg_blank")).alias("part", "kept")).union(p.select(F.lit("pending"), "pending"))


@query(f"SELECT source_id, count(*) AS records, round(avg({sql.wc('v')}), 2) AS words, floor(sum({sql.wc('v')}) * 1.3)::BIGINT AS tokens FROM (SELECT source_id, {_TEXT} AS v FROM lora_storyteller WHERE conversations IS NOT NULL) GROUP BY 1")
def task_word_stats(spark, d):
    r = table(spark, d, "lora_storyteller").where("conversations is not null").select("source_id", tx.word_count(shape.record_text("conversations")).alias("w"))
    return r.groupBy("source_id").agg(F.count("*").alias("records"), F.round(F.avg("w"), 2).alias("words"), F.floor(F.sum("w") * F.lit(1.3)).cast("long").alias("tokens"))


@query("SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def stream_state_upsert(spark, d):
    """The state a stream of events leaves once all have arrived: micro-batches merged by key, then read at rest."""
    import uuid

    from ..session import shared_dir
    from ..streaming.state import current, keep_latest

    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    keep_latest(stream, "user_id", ["ts", "event_id"], ["ts", "event_type"], folder).awaitTermination()
    return current(spark, folder)[0].select("user_id", "ts", "event_type")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
