"""The test tables as the inputs of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import LITERATURE_CATEGORY
from ..operators.shape import unique_chunks
from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source's name and tags; the language defaults to English."""
    d = spread(table(spark, sf_dir, "documents"))
    c = table(spark, sf_dir, "crawl_source").select(F.col("source_id").alias("sid"), "display_name", "tags")
    return d.join(c, d["source"] == c["sid"], "left").select(
        "doc_id", "text", "url", F.col("source").alias("source_id"), "category", F.coalesce("lang", F.lit("en")).alias("language"), "display_name", "tags"
    )


def rpg_chunks(spark: SparkSession, sf_dir: str, max_words: int = 350) -> DataFrame:
    pages = raw_pages(spark, sf_dir)
    return unique_chunks(pages.where(F.coalesce("category", F.lit("")) != LITERATURE_CATEGORY), max_words)


def literature_chunks(spark: SparkSession, sf_dir: str, max_words: int = 350) -> DataFrame:
    return unique_chunks(raw_pages(spark, sf_dir).where(F.col("category") == LITERATURE_CATEGORY), max_words)


def health_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset tables as records of files: (file, format, text, source, language, pending, valid)."""
    from ..operators.report import is_pending
    from ..operators.shape import turn

    def gpt(conversations: str) -> Column:
        values = F.transform(F.filter(conversations, lambda t: t["from"] == "gpt"), lambda t: F.coalesce(t["value"], F.lit("")))
        return F.array_join(values, " ")

    def rows(name, fmt, text, source, language, pending, valid):
        return spread(table(spark, sf_dir, name)).select(
            F.lit(f"{name}.jsonl").alias("file"), F.lit(fmt).alias("format"), F.coalesce(text, F.lit("")).alias("text"),
            source.alias("source"), F.coalesce(language, F.lit("en" if fmt == "alpaca" else "unknown")).alias("language"), pending.alias("pending"), valid.alias("valid"),
        )

    no, null = F.lit(False), F.lit(None).cast("string")
    chat = F.coalesce(F.size("conversations") > 0, no)
    return (
        rows("rpg_dataset", "alpaca", F.col("output"), F.col("source_id"), F.col("language"), no, F.col("instruction").isNotNull() & F.col("output").isNotNull())
        .unionByName(rows("literature_dataset", "alpaca", F.col("output"), F.col("metadata.source_id"), F.col("metadata.language"), no, F.col("instruction").isNotNull() & F.col("output").isNotNull()))
        .unionByName(rows("lora_storyteller", "sharegpt", gpt("conversations"), F.col("source_id"), null, no, chat))
        .unionByName(rows("lora_translator", "sharegpt", gpt("conversations"), F.col("source_id"), F.col("language"), no, chat))
        .unionByName(
            rows("lora_storyteller_dpo", "dpo", F.concat(F.coalesce("prompt", F.lit("")), F.lit(" "), F.coalesce(turn("chosen", "gpt"), F.lit(""))), null, null, is_pending("chosen"), F.col("prompt").isNotNull())
        )
    )
