"""Pieces of DuckDB SQL, the counterpart of ``functions`` and ``operators`` for checks."""

from __future__ import annotations

from ..functions import fixed

WS = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


def words(x: str) -> str:
    return f"(CASE WHEN {strip(x)} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({strip(x)}, '{WS}+') END)"


def wc(x: str) -> str:
    return f"len({words(f'coalesce({x}, {q("")})')})"


def lines(x: str) -> str:
    ends = "(?:\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}])"
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(regexp_replace({x}, '{ends}\\z', ''), '{ends}') END)"


def even(x: str) -> str:
    return strip(f"regexp_replace(replace({x}, chr(13) || chr(10), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def sentences(x: str, marks: str = ".!?。！？") -> str:
    return f"string_split(regexp_replace({strip(x)}, '([{marks}]){WS}+', '\\1' || chr(1), 'g'), chr(1))"


def pick(n: int, *key: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(key)})), 1, 8))::UBIGINT % {n})::BIGINT"


def case_map(x: str, table: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {default} END"


def in_list(items: list[str]) -> str:
    return "[" + ", ".join(map(q, items)) + "]"


def matches(x: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"regexp_matches({x}, {q('(?i)' + p)})::INT" for p in patterns) + ")"


def single_word_lines(x: str) -> str:
    filled = f"list_filter({lines(x)}, lambda s: {strip('s')} <> '')"
    return f"(CASE WHEN len({filled}) > 0 THEN len(list_filter({filled}, lambda s: {wc('s')} = 1))::DOUBLE / len({filled}) ELSE 0.0 END)"


def count_of(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


KANA, HAN = "[\\x{3040}-\\x{30ff}]", "[\\x{4e00}-\\x{9fff}]"


def mismatch(x: str, language: str) -> str:
    letters = count_of(x, "\\pL")
    kana_letters = f"len(list_filter(regexp_extract_all({x}, '{KANA}'), lambda k: regexp_matches(k, '\\pL')))"
    return (
        f"(CASE WHEN {letters} = 0 THEN false WHEN {language} = 'en' THEN {count_of(x, '[A-Za-z]')}::DOUBLE / {letters} < 0.70 "
        f"WHEN {language} = 'ja' THEN ({count_of(x, HAN)} + {kana_letters})::DOUBLE / {letters} < 0.30 ELSE false END)"
    )


def mean_word_length(x: str) -> str:
    return f"(CASE WHEN {wc(x)} > 0 THEN length(regexp_replace({x}, '{WS}', '', 'g'))::DOUBLE / {wc(x)} ELSE 0.0 END)"


def kana_share(x: str) -> str:
    return f"(CASE WHEN length({x}) > 0 THEN {count_of(x, KANA)}::DOUBLE / length({x}) ELSE 0.0 END)"


def reject_reason(x: str, language: str, min_words: int = 80) -> str:
    return (
        f"(CASE WHEN {wc(x)} < {min_words} THEN 'short' WHEN {single_word_lines(x)} > 0.30 THEN 'list' "
        f"WHEN NOT regexp_matches({x}, '[A-Za-z]|{KANA}|{HAN}') THEN 'letters' "
        f"WHEN {language} = 'en' AND NOT ({mean_word_length(x)} BETWEEN 3.0 AND 12.0) THEN 'word_length' "
        f"WHEN {language} = 'ja' AND {kana_share(x)} < 0.10 THEN 'kana' WHEN {mismatch(x, language)} THEN 'language' "
        f"WHEN {matches(x, fixed.BOILERPLATE)} >= {fixed.BOILERPLATE_LEAST} THEN 'boilerplate' END)"
    )


RAW = (
    "raw AS (SELECT d.doc_id, d.text, d.url, d.source AS source_id, d.category, coalesce(d.lang, 'en') AS language, c.display_name, c.tags "
    "FROM documents d LEFT JOIN crawl_source c ON d.source = c.source_id)"
)


def packed(max_words: int, min_words: int = 80) -> str:
    """CTEs up to packed(doc_id, pos, chunk, words): the fold as ``list_reduce``."""
    long_part = f"list_transform({sentences('p')}, lambda s: {{'t': s, 'w': {wc('s')}, 'r': i}})"
    short_part = f"[{{'t': p, 'w': {wc('p')}, 'r': 0}}]"
    start = "{'done': []::STRUCT(chunk VARCHAR, words BIGINT)[], 'buf': NULL::VARCHAR, 'bw': 0::BIGINT, 'run': -1::BIGINT}"
    return f"""{RAW},
paras AS (SELECT doc_id, list_filter(list_transform(string_split({even('text')}, chr(10) || chr(10)), lambda p: {strip('p')}), lambda p: p <> '') AS ps FROM raw WHERE text IS NOT NULL),
units AS (SELECT doc_id, flatten(list_transform(ps, lambda p, i: CASE WHEN {wc('p')} > {max_words} THEN {long_part} ELSE {short_part} END)) AS us FROM paras),
folded AS (SELECT doc_id, list_reduce(us, lambda a, u: CASE WHEN a.buf IS NOT NULL AND a.run = u.r AND a.bw + u.w <= {max_words}
  THEN {{'done': a.done, 'buf': a.buf || (CASE WHEN u.r = 0 THEN chr(10) || chr(10) ELSE ' ' END) || u.t, 'bw': a.bw + u.w, 'run': u.r}}
  ELSE {{'done': CASE WHEN a.buf IS NULL THEN a.done ELSE list_append(a.done, {{'chunk': a.buf, 'words': a.bw}}) END, 'buf': u.t, 'bw': u.w, 'run': u.r}} END, {start}) AS f FROM units),
lists AS (SELECT doc_id, list_filter(CASE WHEN f.buf IS NULL THEN f.done ELSE list_append(f.done, {{'chunk': f.buf, 'words': f.bw}}) END, lambda c: c.words >= {min_words}) AS cs FROM folded),
packed AS (SELECT doc_id, unnest(range(len(cs))) AS pos, unnest(cs).chunk AS chunk, unnest(cs).words AS words FROM lists)"""


def sound(max_words: int) -> str:
    """CTEs up to sound(doc_id, pos, chunk, words and the columns of raw)."""
    bag = "list_distinct(" + words("lower(p.chunk)") + ")"
    return f"""{packed(max_words)},
gated AS (SELECT p.doc_id, list({{'chunk': p.chunk, 'words': p.words, 'bag': {bag}}} ORDER BY p.pos) AS cs FROM packed p JOIN raw r USING (doc_id) WHERE {reject_reason('p.chunk', 'r.language')} IS NULL GROUP BY p.doc_id),
kept AS (SELECT doc_id, list_reduce(cs, lambda a, x: CASE WHEN len(x.bag) > 0 AND len(list_filter(a, lambda k: len(k.bag) > 0 AND len(list_intersect(k.bag, x.bag))::DOUBLE / len(list_distinct(list_concat(k.bag, x.bag))) >= 0.85)) > 0
  THEN a ELSE list_append(a, x) END, []::STRUCT(chunk VARCHAR, words BIGINT, bag VARCHAR[])[]) AS ks FROM gated),
sound AS (SELECT k.*, r.url, r.source_id, r.category, r.language, r.display_name, r.tags FROM (SELECT doc_id, unnest(range(len(ks))) AS pos, unnest(ks).chunk AS chunk, unnest(ks).words AS words FROM kept) k JOIN raw r USING (doc_id))"""


def unique(max_words: int, where: str, prefix: str = "") -> str:
    """CTEs up to uniq(... chunk_index, before, after)."""
    return f"""{sound(max_words)},
firsts AS (SELECT * FROM sound WHERE {where} QUALIFY row_number() OVER (PARTITION BY md5({q(prefix)} || {strip('chunk')}) ORDER BY category NULLS FIRST, source_id NULLS FIRST, url NULLS FIRST, doc_id, pos) = 1),
uniq AS (SELECT *, row_number() OVER w - 1 AS chunk_index, lag(chunk) OVER w AS before, lead(chunk) OVER w AS after FROM firsts WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"""


def first_sentence(x: str) -> str:
    return f"nullif(regexp_extract({x}, '^(.+?[.!?]){WS}', 1), '')"


def topic(x: str) -> str:
    head = strip(f"coalesce({lines(strip(x))}[1], '')")
    titled = f"(regexp_matches({head}, '^[\\p{{Lu}}\\p{{Lt}}]') OR (NOT regexp_matches({head}, '\\p{{Ll}}') AND regexp_matches({head}, '\\p{{Lu}}')) OR (regexp_matches({head}, '\\p{{Lu}}') AND NOT regexp_matches({head}, '(?:^|\\PL)\\p{{Ll}}|\\pL\\p{{Lu}}')))"
    rest = f"list_filter({words(first_sentence(x))}, lambda w: NOT list_contains({in_list(fixed.TOPIC_STOP)}, lower(w)))"
    return (
        f"(CASE WHEN {head} <> '' AND {wc(head)} <= 8 AND {titled} THEN substr({head}, 1, 80) "
        f"ELSE coalesce(array_to_string({rest}[1:8], ' '), array_to_string({words(x)}[1:8], ' ')) END)"
    )


def prompt(x: str, before: str) -> str:
    last = strip(f"{sentences(before, '.!?')}[-1]")
    return (
        f"(CASE WHEN {before} <> '' AND {wc(last)} >= 5 THEN substr({last}, 1, 200) "
        f"ELSE coalesce(substr({first_sentence(x)}, 1, 200), array_to_string({words(x)}[1:20], ' ')) END)"
    )


def genre(tags: str, table: dict[str, str], default: str) -> str:
    first = f"list_filter({tags}, lambda t: list_contains({in_list(list(table))}, t))[1]"
    return f"coalesce({case_map(first, table, 'NULL')}, {q(default)})"


def filled(template: list[str], number: str, **values: str) -> str:
    text = f"({in_list(template)})[{number} + 1]"
    for name, value in values.items():
        text = f"replace({text}, {q('{' + name + '}')}, {value})"
    return text


def sentiment(x: str) -> str:
    seen = f"list_distinct(list_filter(regexp_extract_all(lower({x}), '[\\pL\\pM\\pN_]+'), lambda w: regexp_full_match(w, '[a-z]+')))"
    pos, neg, act = (f"len(list_intersect({seen}, {in_list(ws)}))" for ws in (fixed.POSITIVE, fixed.NEGATIVE, fixed.ACTION))
    s = {k: q(v) for k, v in fixed.SENTIMENTS.items()}
    return f"(CASE WHEN {act} > {pos} AND {act} > {neg} THEN {s['action']} WHEN {neg} > {pos} THEN {s['negative']} WHEN {pos} > {neg} THEN {s['positive']} ELSE {s['neutral']} END)"
