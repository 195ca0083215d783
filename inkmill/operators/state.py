"""Keyed state: what was crawled or transferred, what changed, and in which order hosts are visited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.when(found != "", F.lower(found))


def source_id_of(url: Column) -> Column:
    """The first label of a URL's host without www., dashes as underscores."""
    return F.replace(F.split_part(F.replace(host(url), F.lit("www."), F.lit("")), F.lit("."), F.lit(1)), F.lit("-"), F.lit("_"))


def file_name(url: Column) -> Column:
    """A safe file name: the path with underscores, the host for an empty path; long ones are cut and get a hash."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), "^/+|/+$", "")
    name = F.when(path == "", F.replace(host(url), F.lit("."), F.lit("_"))).otherwise(F.replace(path, F.lit("/"), F.lit("_")))
    safe = F.regexp_replace(name, r"(?U)[^\w\-]", "_")
    return F.when(F.length(safe) > 80, F.concat(F.substring(safe, 1, 72), F.lit("_"), F.substring(F.md5(url), 1, 7))).otherwise(safe)


def latest(rows: DataFrame, key: str, order: list[str], *values: str) -> DataFrame:
    """The state after all rows: per key the values of its last row; maxima are taken with partial sums before the shuffle."""
    last = F.max(F.struct(*order, *[v for v in values if v not in order])).alias("s")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(last).select(key, *[f"s.{v}" for v in values])


def crawl_decision(visits: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    """(key, outcome) of new visits (key, http_status, words, checksum) against the state (key, status, checksum).

    304 or an unchanged checksum is ``unchanged``, an empty text ``failed``, a changed known page ``updated``, else ``stored``.
    """
    known = state.select(F.col(key).alias("k"), F.col("status").alias("old_status"), F.col("checksum").alias("old_checksum"))
    was_ok = F.coalesce(F.col("old_status") == "ok", F.lit(False))
    return visits.join(known, F.col(key) == F.col("k"), "left").select(
        *visits.columns,
        F.when(F.col("http_status") == 304, "unchanged")
        .when(F.coalesce("words", F.lit(0)) == 0, "failed")
        .when(was_ok & F.coalesce(F.col("checksum") == F.col("old_checksum"), F.lit(False)), "unchanged")
        .when(was_ok, "updated")
        .otherwise("stored")
        .alias("outcome"),
    )


def transfer_decision(files: DataFrame, state: DataFrame, targets: DataFrame, overwrite: bool = False) -> DataFrame:
    """(path, outcome) of files (path, type_key, md5, exists): done, no_target, exists or transfer."""
    done = state.select(F.col("path").alias("p"), F.col("md5").alias("m")).distinct()
    to = targets.select(F.col("type_key").alias("t"), "target")
    j = files.join(done, (F.col("path") == F.col("p")) & (F.col("md5") == F.col("m")), "left").join(to, F.col("type_key") == F.col("t"), "left")
    return j.select(
        "path",
        F.when(F.col("p").isNotNull(), "done")
        .when(F.coalesce("target", F.lit("")) == "", "no_target")
        .when(F.col("exists") & F.lit(not overwrite), "exists")
        .otherwise("transfer")
        .alias("outcome"),
    )


def interleaved(rows: DataFrame, url: str, order: str) -> DataFrame:
    """``rows`` with ``host`` and ``turn``: round robin over hosts, so that no host is visited twice in a row needlessly."""
    return rows.withColumn("host", host(F.col(url))).withColumn("turn", F.row_number().over(Window.partitionBy("host").orderBy(order)).cast("long"))


def referer(url: Column) -> Column:
    """Where a reader of a page would come from, by site."""
    at = host(url)
    has = lambda s: F.contains(at, F.lit(s))
    return (
        F.when(has("fandom.com"), F.concat(F.lit("https://"), at, F.lit("/wiki/")))
        .when(has("lexicanum.com"), F.concat(F.lit("https://"), at, F.lit("/wiki/Main_Page")))
        .when(has("royalroad.com"), "https://www.royalroad.com/")
        .when(has("archiveofourown.org"), "https://archiveofourown.org/")
        .when(has("syosetu.com"), "https://yomou.syosetu.com/")
        .otherwise(F.concat(F.lit("https://"), at, F.lit("/")))
    )


def chunk_refs(chunks: DataFrame, world: str, url: str, position: str) -> Column:
    """``ref_<world>_<md5 of the address, 8 digits>_<position>``."""
    return F.concat_ws("_", F.lit("ref"), F.col(world), F.substring(F.md5(F.col(url)), 1, 8), F.col(position).cast("string"))


__all__ = ["chunk_refs", "crawl_decision", "file_name", "host", "interleaved", "latest", "referer", "source_id_of", "transfer_decision"]
