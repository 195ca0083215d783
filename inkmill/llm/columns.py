"""Column expressions shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def source_key(source: Column) -> Column:
    """One key for all spellings of a source: lower case, letters and digits only; null for null or nothing left."""
    key = F.lower(F.regexp_replace(source, r"[^\p{L}\p{N}]", ""))
    return F.when(key != "", key)


def language_key(language: Column) -> Column:
    """The primary subtag in lower case (``en-US``, ``en_us`` and ``EN`` are ``en``); null for null or blank."""
    key = F.lower(F.regexp_extract(F.trim(language), r"^([A-Za-z]+)", 1))
    return F.when(key != "", key)


def take(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under the given names: whatever else a table holds can't clash."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def turns(conversations: str) -> Column:
    """The non-null turns of a conversation as ``array<struct<role, value>>``; empty for null."""
    cleaned = F.transform(
        F.filter(F.col(conversations), lambda t: t.isNotNull()),
        lambda t: F.struct(F.coalesce(t["from"], F.lit("")).alias("role"), F.coalesce(t["value"], F.lit("")).alias("value")),
    )
    return F.coalesce(cleaned, F.array().cast("array<struct<role:string,value:string>>"))


LONG_ARRAY = T.ArrayType(T.LongType())
