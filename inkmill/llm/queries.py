"""The pN_ queries: each runs its problem's operator, with production parameters, over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import spread
from . import answers, caps, copies, history, leaks, pages, repetition, residue, tokens
from .columns import take

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with template slots, filler, error messages or demands for scripts."""
    t = lambda name: _table(spark, sf_dir, name)
    return residue.residue(t("rpg_dataset"), t("literature_dataset")).select("rec_id").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that have to go so that no contributor keeps more than 2 % of all rows."""
    return caps.over_cap(_table(spark, sf_dir, "rpg_dataset")).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of different batches that bring the same output, lightly changed or not."""
    t = lambda name: _table(spark, sf_dir, name)
    return history.repeats(t("rpg_dataset"), t("literature_dataset"))


def p4_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by table, source, language and domain."""
    t = lambda name: _table(spark, sf_dir, name)
    return tokens.budget(tokens.count_records(t("rpg_dataset"), t("lora_translator")), t("crawl_source"))


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each record."""
    t = lambda name: _table(spark, sf_dir, name)
    return tokens.count_records(t("rpg_dataset"), t("lora_translator"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose answer doesn't answer, with the kind of defect."""
    rpg = take(_table(spark, sf_dir, "rpg_dataset"), id="rec_id", question="instruction", answer="output")
    pairs = rpg.unionByName(answers.last_exchange(_table(spark, sf_dir, "lora_storyteller_dpo")))
    return answers.defects(pairs).withColumnRenamed("id", "rec_id").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages that aren't part of the body."""
    return pages.furniture(_table(spark, sf_dir, "rpg_dataset")).distinct()


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the smallest id among its copies and their number."""
    t = lambda name: _table(spark, sf_dir, name)
    return copies.classes(copies.canonical_rows((t("rpg_dataset"), "rec_id", "output"), (t("lora_storyteller"), "rec_id", "conversations")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies but for formatting, each with the smallest id of its group."""
    return copies.pairs(p7_classes(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document by byte_bpe_50k."""
    return tokens.encode(_table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items whose passages they contain."""
    found = leaks.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_item"))
    return leaks.leaked(found).select("doc_id", "item_id").distinct()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which more than 45 % has been given before."""
    found = repetition.repetition(_table(spark, sf_dir, "documents"))
    return found.where(found["share"] > repetition.LIMIT).select("doc_id").distinct()


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path length and repeated share of each document."""
    return repetition.repetition(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p4_budget, p4_records, p5_found, p6_found, p7_found, p7_classes, p8_ids, p9_found, p10_found, p10_shares)}


def oracle_sql() -> dict[str, str]:
    return {}
