"""Counts, percentiles, health and its changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import DATASET_TYPES, HEALTH, HEALTH_BY_FILE, PENDING, STATUS
from ..functions.quality import is_bad
from ..functions.text import md5_of, strip, word_count
from ..session import stored


def dataset_stats(records: DataFrame, words: str, source: str, language: str) -> DataFrame:
    """(kind, name, records, total_words, avg_words, min_words, max_words): all rows, then by source and by language."""
    sets = records.groupingSets([[], [F.col(source)], [F.col(language)]], F.col(source), F.col(language))
    by = F.grouping_id()
    return sets.agg(
        by.alias("g"),
        F.count("*").alias("records"),
        F.sum(words).alias("total_words"),
        F.round(F.avg(words), 1).alias("avg_words"),
        F.min(words).alias("min_words"),
        F.max(words).alias("max_words"),
    ).select(
        F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "source").otherwise("language").alias("kind"),
        F.when(F.col("g") == 1, F.col(source)).when(F.col("g") == 2, F.col(language)).alias("name"),
        "records",
        "total_words",
        "avg_words",
        "min_words",
        "max_words",
    )


def nearest_rank(rows: DataFrame, value: str, by: list[str], percents: tuple[int, ...] = (25, 50, 75), weight: str | None = None) -> DataFrame:
    """Per group the value at place min(floor(n p / 100), n - 1) of the sorted values, as ``p25`` and so on; ``least`` and ``most``.

    Values are counted first, so only distinct values and their numbers are ordered, never the rows of a group. A row counts
    ``weight`` times, if given.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(group))
    out = []
    for p in percents:
        at = F.least(F.floor(F.col("_all") * p / 100), F.col("_all") - 1)
        out.append(F.max(F.when((F.col("_upto") > at) & (F.col("_upto") - F.col("_n") <= at), F.col(value))).alias(f"p{p}"))
    return placed.groupBy(*by).agg(*out, F.min(value).alias("least"), F.max(value).alias("most"))


def counted_texts(records: DataFrame) -> DataFrame:
    """What health asks of the records of files (file, format, text, source, language, pending, valid), read once.

    One row per file, source, language and distinct text, without the text: its checksum, its words, and how often it is there, is
    bad or pending. It is written to the shared folder, as all figures come from it.
    """
    valid = F.col("valid")
    small = records.select(
        "file", "format", "source", "language", "valid",
        F.when(valid, md5_of(F.coalesce("text", F.lit("")))).alias("h"), F.when(valid, word_count(F.col("text"))).alias("w"),
        (valid & is_bad(F.col("text"))).cast("long").alias("bad"), (valid & F.col("pending")).cast("long").alias("pending"),
    )
    by = ["file", "format", "source", "language", "valid", "h", "w"]
    return stored(small.groupBy(*by).agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("pending").alias("pending")), "health")


def file_metrics(records: DataFrame) -> DataFrame:
    """Health metrics per file of records (file, format, text, source, language, pending, valid), which are read once.

    ``valid`` tells a record from a line that couldn't be read. Counts are sums; copies are records less distinct texts.
    """
    return metrics_of(counted_texts(records))


def metrics_of(counted: DataFrame) -> DataFrame:
    """``file_metrics`` from ``counted_texts``."""
    valid = lambda c: F.sum(F.when(F.col("valid"), F.col(c)).otherwise(0))
    base = counted.groupBy("file").agg(
        F.sum("n").alias("total_lines"),
        F.min("format").alias("format"),
        valid("n").alias("valid_records"),
        F.sum(F.when(~F.col("valid"), F.col("n")).otherwise(0)).alias("format_errors"),
        F.sum("bad").alias("bad_samples"),
        F.sum("pending").alias("needs_generation"),
    )
    r = counted.where("valid")
    dups = r.groupBy("file", "h").agg(F.sum("n").alias("n")).groupBy("file").agg((F.sum("n") - F.count("*")).alias("exact_dups"))
    ranks = nearest_rank(r, "w", ["file"], (25, 50, 75), "n")
    out = base.join(dups, "file", "left").join(ranks, "file", "left")
    return out.select(
        "file", "format", "total_lines", "valid_records", "format_errors", "bad_samples", F.coalesce("exact_dups", F.lit(0)).alias("exact_dups"),
        "needs_generation", F.col("least").alias("word_count_min"), F.col("p25").alias("word_count_p25"), F.col("p50").alias("word_count_median"),
        F.col("p75").alias("word_count_p75"), F.col("most").alias("word_count_max"),
    )


def breakdown(counted: DataFrame) -> DataFrame:
    """(file, kind, name, records, bad) by source and by language from ``counted_texts``; a missing name is ``unknown``."""
    r = counted.where("valid").withColumn("source", F.coalesce("source", F.lit("unknown"))).withColumn("language", F.coalesce("language", F.lit("unknown")))
    sets = r.groupingSets([[F.col("file"), F.col("source")], [F.col("file"), F.col("language")]], F.col("file"), F.col("source"), F.col("language"))
    made = sets.agg(F.grouping("source").alias("g"), F.sum("n").alias("records"), F.sum("bad").alias("bad"))
    return made.select(
        "file", F.when(F.col("g") == 0, "source").otherwise("language").alias("kind"), F.when(F.col("g") == 0, F.col("source")).otherwise(F.col("language")).alias("name"), "records", "bad"
    )


def as_maps(parts: DataFrame) -> DataFrame:
    """(file, by_source, by_language, bad_sources): a ``breakdown`` as maps, the largest counts first, languages by name."""
    one = lambda cond, count: F.collect_list(F.when(F.expr(cond), F.struct((-F.col(count)).alias("k"), F.col("name"), F.col(count).alias("n"))))
    mapped = lambda a: F.map_from_entries(F.transform(F.array_sort(a), lambda x: F.struct(x["name"], x["n"])))
    by_name = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == "language", F.struct("name", "records")))))
    return parts.groupBy("file").agg(
        mapped(one("kind = 'source'", "records")).alias("by_source"), by_name.alias("by_language"), mapped(one("kind = 'source' and bad > 0", "bad")).alias("bad_sources")
    )


def worst_sources(parts: DataFrame, most: int = 3) -> DataFrame:
    """(file, source, bad, place): of each file the sources with the most bad samples, three of them being the feature."""
    place = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("bad"), "name"))
    return parts.where("kind = 'source' and bad > 0").withColumn("place", place.cast("long")).where(F.col("place") <= most).select("file", F.col("name").alias("source"), "bad", "place")


def _limit(name: str) -> Column:
    out = F.lit(HEALTH[name])
    for file, own in HEALTH_BY_FILE.items():
        if name in own:
            out = F.when(F.col("file") == file, own[name]).otherwise(out)
    return out


def health_status(metrics: DataFrame) -> DataFrame:
    """Metrics with ``bad_rate``, ``dup_rate`` and ``status``: waiting, empty, danger, warn or healthy, in this order."""
    n = F.col("valid_records")
    rated = metrics.withColumn("bad_rate", F.when(n > 0, F.col("bad_samples") / n)).withColumn("dup_rate", F.when(n > 0, F.col("exact_dups") / n))
    danger = (F.col("bad_rate") > HEALTH["bad_rate_danger"]) | (F.col("dup_rate") > HEALTH["dup_rate_danger"])
    warn = (
        (F.col("bad_rate") > HEALTH["bad_rate_warn"])
        | (F.col("dup_rate") > HEALTH["dup_rate_warn"])
        | (n < _limit("min_records"))
        | (F.coalesce("word_count_median", F.lit(0)) < _limit("min_word_median"))
    )
    waiting = (F.col("format") == "dpo") & (F.col("needs_generation") > 0) & (F.col("needs_generation") == n)
    status = (
        F.when(waiting, STATUS["waiting"]).when(n == 0, STATUS["empty"]).when(danger, STATUS["danger"]).when(warn, STATUS["warn"]).otherwise(STATUS["healthy"])
    )
    return rated.withColumn("status", status)


def overall(statuses: DataFrame) -> DataFrame:
    """One row: files, records, bad samples, and how many files are healthy, warned or in danger (empty ones among these)."""
    is_ = lambda *s: F.sum(F.col("status").isin(*[STATUS[x] for x in s]).cast("long"))
    return statuses.agg(
        F.count("*").alias("files"),
        F.sum("valid_records").alias("records"),
        F.sum("bad_samples").alias("bad"),
        is_("healthy").alias("healthy"),
        is_("warn").alias("warned"),
        is_("danger", "empty").alias("in_danger"),
        is_("waiting").alias("waiting"),
    )


def suggestions(statuses: DataFrame) -> DataFrame:
    """(file, suggestion): what to do about each file, by kind."""
    n = F.col("valid_records")
    each = F.array_compact(
        F.array(
            F.when(n == 0, "check_crawl"),
            F.when(F.col("bad_rate") > HEALTH["bad_rate_danger"], "drop_sources").when(F.col("bad_rate") > HEALTH["bad_rate_warn"], "check_sources"),
            F.when(F.col("dup_rate") > HEALTH["dup_rate_warn"], "dedup"),
            F.when((n > 0) & (n < HEALTH["min_records"]), "more_records"),
        )
    )
    return statuses.select("file", F.explode(each).alias("suggestion"))


def delta(new: DataFrame, old: DataFrame, key: str, *values: str) -> DataFrame:
    """(key, value, old_value, change, trend) for each value of two snapshots: ↓ ↑ or → , null without an old one."""
    a = new.select(key, F.explode(F.create_map(*[y for v in values for y in (F.lit(v), F.col(v).cast("double"))])).alias("value", "new_value"))
    b = old.select(key, F.explode(F.create_map(*[y for v in values for y in (F.lit(v), F.col(v).cast("double"))])).alias("value", "old_value"))
    d = F.col("new_value") - F.col("old_value")
    return a.join(b, [key, "value"], "left").select(
        key, "value", "old_value", d.alias("change"), F.when(d < 0, "↓").when(d > 0, "↑").when(d == 0, "→").alias("trend")
    )


def bad_by_source(records: DataFrame, text: str, source: str) -> DataFrame:
    """(source, bad) of the sources with bad samples."""
    return records.where(is_bad(F.col(text))).groupBy(F.col(source).alias("source")).agg(F.count("*").alias("bad"))


def record_errors(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with ``error``: blank, bad_json, missing_field, blank_output; null for a sound instruction record."""
    keys = F.try_json_keys(F.col(line)) if hasattr(F, "try_json_keys") else F.json_object_keys(F.col(line))
    has = lambda *k: F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(x) for x in k])), F.lit(False))
    return lines.withColumn(
        "error",
        F.when(strip(F.col(line)) == "", "blank")
        .when(keys.isNull(), "bad_json")
        .when(~(has("instruction") & has("output") & has("metadata")), "missing_field")
        .when(strip(F.coalesce(F.get_json_object(line, "$.output"), F.lit(""))) == "", "blank_output"),
    )


def record_format(line: Column) -> Column:
    """sharegpt, alpaca, dpo or unknown by the keys of a JSON object; null for other lines."""
    keys = F.json_object_keys(line)
    has = lambda k: F.array_contains(keys, k)
    return F.when(keys.isNull(), None).otherwise(
        F.when(has("conversations"), "sharegpt").when(has("instruction") & has("output"), "alpaca").when(has("prompt") & has("chosen"), "dpo").otherwise("unknown")
    )


def dataset_type(stem: Column) -> Column:
    """The first known name that a file's stem contains."""
    out = F.lit("unknown")
    for name in reversed(DATASET_TYPES):
        out = F.when(F.contains(F.lower(stem), F.lit(name)), name).otherwise(out)
    return out


def is_pending(chosen: str) -> Column:
    """Whether a gpt turn of the chosen answer still holds the placeholder."""
    return F.coalesce(F.exists(chosen, lambda t: (t["from"] == "gpt") & F.contains(F.coalesce(t["value"], F.lit("")), F.lit(PENDING))), F.lit(False))


def markdown(statuses: DataFrame, changes: DataFrame | None = None) -> str:
    """A report of all files (one row each, so a small result) and of what changed, as Markdown."""
    columns = ["file", "status", "valid_records", "bad_samples", "exact_dups", "word_count_median", "needs_generation"]
    out = ["# Dataset health", "", "| " + " | ".join(columns) + " |", "|" + "-|" * len(columns)]
    out += ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in columns) + " |" for r in statuses.select(*columns).orderBy("file").collect()]
    if advice := suggestions(statuses).orderBy("file", "suggestion").collect():
        out += ["", "## Suggestions", ""] + [f"- `{r['file']}`: {r['suggestion']}" for r in advice]
    if changes is not None:
        moved = changes.where("trend in ('↓', '↑')").orderBy(changes.columns[0], "value").collect()
        out += ["", "## Changes", ""] + [f"- `{r[0]}` {r['value']}: {r['trend']} {abs(r['change']):g}" for r in moved]
    return "\n".join(out) + "\n"
