"""Exact copies: the first of each, their number, sets of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import md5_of


def first_of_each(rows: DataFrame, key: Column, *order: str) -> DataFrame:
    """Of rows with one ``key`` the first by ``order``; all columns stay. Rows with a null key are all kept.

    Each task keeps one row per key before the shuffle, so that a key with very many rows stays small and the rows are made once.
    """
    alone = F.concat(F.lit("null "), F.to_json(F.struct(*order)))
    found = rows.groupBy(F.coalesce(key, alone).alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return found.select("_row.*")


def exact_first(rows: DataFrame, text: str, *order: str, prefix: str = "") -> DataFrame:
    """The first row of each stripped text."""
    return first_of_each(rows, md5_of(F.col(text), prefix), *order)


def copies(rows: DataFrame, text: str, *by: str) -> DataFrame:
    """(by, records, distinct_texts, copies) per group; null texts aren't records."""
    one = rows.where(F.col(text).isNotNull()).groupBy(*by, md5_of(F.col(text)).alias("h")).agg(F.count("*").alias("n"))
    sums = one.groupBy(*by).agg(F.sum("n").alias("records"), F.count("*").alias("distinct_texts"))
    return sums.withColumn("copies", F.col("records") - F.col("distinct_texts"))


def new_links(found: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """(url): distinct links of ``found`` that ``known`` hasn't, final slashes aside."""
    bare = F.regexp_replace(F.col(url), "/+$", "")
    a = found.select(bare.alias(url)).where(F.col(url).isNotNull()).distinct()
    return a.join(known.select(bare.alias(url)).where(F.col(url).isNotNull()).distinct(), url, "left_anti")
