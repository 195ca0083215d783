"""Seeded shuffles: exact train and validation splits, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hashed(rows: DataFrame, key: str, seed: str = "42") -> DataFrame:
    return rows.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))


def train_val(rows: DataFrame, key: str, ratio: float = 0.9, seed: str = "42") -> DataFrame:
    """``rows`` with ``part``: the first max(1, floor(n ratio)) in order of a keyed hash are ``train``, the rest ``val``.

    The place of the cut is found among counts per prefix of the hash; only rows of the one prefix that is cut are ordered.
    """
    h = hashed(rows, key, seed).withColumn("prefix", F.substring("shuffle_key", 1, 4))
    n = h.groupBy("prefix").agg(F.count("*").alias("n"))
    upto = n.withColumn("before", F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    total = F.sum("n").over(Window.partitionBy())  # of at most 65,536 counts
    cut = upto.withColumn("cut", F.greatest(F.lit(1), F.floor(total * ratio)))
    j = h.join(cut.select("prefix", "before", "n", "cut"), "prefix")
    whole = j.where("before + n <= cut or before >= cut").withColumn("part", F.when(F.col("before") + F.col("n") <= F.col("cut"), "train").otherwise("val"))
    place = F.row_number().over(Window.partitionBy("prefix").orderBy("shuffle_key", key))
    split = j.where("before + n > cut and before < cut").withColumn("part", F.when(F.col("before") + place <= F.col("cut"), "train").otherwise("val"))
    return whole.unionByName(split).drop("shuffle_key", "prefix", "before", "n", "cut")


def sample(rows: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """``n`` rows, those with the smallest keyed hashes."""
    return hashed(rows, key, seed).orderBy("shuffle_key", key).limit(n).drop("shuffle_key")
