"""Problem 2: a cap per contributor, kept by quality and apportioned over strata."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import source_key, take
from .quality import SOUND, score

#: Steps of a score, and of the hash that orders equal scores: what the ranking counts before it looks at single rows.
SCORE_STEPS, TIE_STEPS = 1000, 4096


@F.pandas_udf(T.DoubleType())
def _scores(questions: pd.Series, answers: pd.Series) -> pd.Series:
    return pd.Series([score(q, a) for q, a in zip(questions, answers)], dtype=float)


def _apportioned(table: DataFrame, seats: Column, weight: str, name: str) -> DataFrame:
    """``table`` with ``name``: ``seats`` of each contributor over its strata, in proportion to ``weight``, by largest remainder."""
    whole = Window.partitionBy("contributor")
    share = F.when(F.sum(weight).over(whole) > 0, seats * F.col(weight) / F.sum(weight).over(whole)).otherwise(0.0)
    t = table.withColumn("share", share).withColumn("floor", F.floor("share"))
    t = t.withColumn("left", F.round(F.when(F.sum(weight).over(whole) > 0, seats - F.sum("floor").over(whole)).otherwise(0)))
    place = F.row_number().over(whole.orderBy(F.desc(F.col("share") - F.col("floor")), F.desc(weight), "stratum"))
    return t.withColumn(name, (F.col("floor") + F.when(place <= F.col("left"), 1).otherwise(0)).cast("long")).drop("share", "floor", "left")


def _first_of(rows: DataFrame, by: list[str], step: str, wanted: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``step`` lies wholly within the first ``wanted`` of their group, and those of the one step that is split.

    Only counts per group and step are ordered, never the rows of a group; the rest of the rows is in neither part. ``wanted`` of
    the second part is what remains for its step.
    """
    counts = rows.groupBy(*by, step).agg(F.count("*").alias("n"), F.first(wanted).alias("w"))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, 0))
    cut = counts.withColumn("upto", upto).where(F.col("upto") - F.col("n") < F.col("w"))
    cut = cut.select(*by, step, (F.col("upto") <= F.col("w")).alias("within"), (F.col("w") - F.col("upto") + F.col("n")).alias("rest"))
    met = rows.drop(wanted)
    for c in (*by, step):
        cut = cut.withColumnRenamed(c, f"cut_{c}")
    same = [met[c].eqNullSafe(cut[f"cut_{c}"]) for c in (*by, step)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    met = met.join(cut, on).drop(*[f"cut_{c}" for c in (*by, step)])
    return met.where("within").drop("within", "rest"), met.where("not within").withColumnRenamed("rest", wanted).drop("within")


def over_cap(
    rows: DataFrame,
    share: float = 0.02,
    key: str = "rec_id",
    source: str = "source_id",
    stratum: str = "batch_id",
    question: str = "instruction",
    answer: str = "output",
) -> DataFrame:
    """(key): the rows that have to go so that no contributor keeps more than ``share`` of all rows (rounded down).

    All spellings of a contributor are one; rows without one are never capped but count in the total. Of each contributor
    above the cap the slots are apportioned over its strata (periods of arrival) by largest remainder, in proportion to their
    sound rows; slots that sound rows leave free are apportioned over the rest. Within a stratum the better score stays, then the
    smaller hash and the smaller key. At most 1 / ``share`` contributors can be above the cap, and only their rows are scored;
    ranking runs on counts of scores, so no stratum is sorted as a whole. Null keys are left out of the result; null and empty
    answers score 0; a null stratum is a stratum of its own; equal rows with one key go or stay one by one.
    """
    plain = take(rows, id=F.col(key).cast("long"), contributor=source_key(F.col(source)), stratum=F.col(stratum).cast("string"), question=question, answer=answer)
    sizes = plain.groupBy("contributor").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    cap = int(total * share + 1e-9)
    above = F.broadcast(sizes.where(F.col("contributor").isNotNull() & (F.col("n") > cap)).select("contributor"))
    scored = plain.join(above, "contributor").select(
        "contributor", F.coalesce("stratum", F.lit("")).alias("stratum"), "id", _scores("question", "answer").alias("score")
    )
    scored = stored(
        scored.withColumn("step", F.lit(SCORE_STEPS) - F.floor(F.col("score") * SCORE_STEPS))
        .withColumn("hash", F.xxhash64("id"))
        .withColumn("tie", F.pmod("hash", F.lit(TIE_STEPS))),
        "scored",
    )
    sound = (F.col("score") >= SOUND).cast("long")
    strata = scored.groupBy("contributor", "stratum").agg(F.sum(sound).alias("sound"), F.sum(1 - sound).alias("poor"))
    good = F.sum("sound").over(Window.partitionBy("contributor"))
    strata = strata.withColumn("for_sound", F.least(F.lit(cap), good)).withColumn("spare", F.lit(cap) - F.col("for_sound"))
    strata = _apportioned(strata, F.col("for_sound"), "sound", "q1")
    strata = _apportioned(strata, F.col("spare"), "poor", "q2")
    quota = strata.select("contributor", "stratum", (F.col("q1") + F.col("q2")).alias("slots"))
    ranked = scored.join(quota, ["contributor", "stratum"])
    by = ["contributor", "stratum"]
    kept, split = _first_of(ranked, by, "step", "slots")
    kept_too, split = _first_of(split, [*by, "step"], "tie", "slots")
    last = split.withColumn("place", F.row_number().over(Window.partitionBy(*by, "step", "tie").orderBy(F.desc("score"), "hash", "id"))).where("place <= slots")
    stays = kept.select("id").union(kept_too.select("id")).union(last.select("id"))
    return scored.where("id is not null").select("id").exceptAll(stays).withColumnRenamed("id", key)
