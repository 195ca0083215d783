"""Problems 4 and 8: token budgets and encoding of a corpus with a published tokenizer.

Both run inside one Arrow pass without a shuffle of texts; the vocabulary file is read from a path by each worker (it has a
fixed size, whatever the corpus). See ``bpe`` for the two methods.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe
from .columns import language_key, source_key, take, turns

#: Where the public vocabulary files lie; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE_50K = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = BYTE_BPE_50K) -> DataFrame:
    """(key, ids): the token ids of every text by greedy proposal, pair verification and exact merging of failing words.

    Null and empty texts have an empty list; white space is encoded as it is; repeated rows stay repeated rows; a null key is
    kept. Special-token strings are ordinary text and no special token is added. Whatever the length, the whole text counts.
    """

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(Bpe.load(vocabulary).encode(None if not isinstance(t, str) else t for t in texts))

    return take(docs, **{key: key, "text": text}).select(key, ids("text").alias("ids"))


def _counter(vocabulary: str):
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(Bpe.load(vocabulary).count(None if not isinstance(t, str) else t for t in texts), dtype="int64")

    @F.pandas_udf("long")
    def count_all(lists: pd.Series) -> pd.Series:
        sizes = [0 if x is None else len(x) for x in lists]
        flat = iter(Bpe.load(vocabulary).count(t for x in lists if x is not None for t in x))
        return pd.Series([sum(next(flat) for _ in range(n)) for n in sizes], dtype="int64")

    return count, count_all


def count_records(rpg: DataFrame, translator: DataFrame, vocabulary: str = BYTE_BPE_50K) -> DataFrame:
    """(table_name, rec_id, source, language, domain, tokens): exact token counts per record.

    ``tokens`` is that of ``output``, or the sum over the turns of ``conversations``; 0 for null, empty or missing texts.
    ``source`` and ``language`` are folded keys (null stays null), ``domain`` is the category in ``metadata`` or null.
    Each partition builds the prefix trie of the distinct pieces of its batches and joins the terminal counts to its records
    in place, so no piece is ever shuffled.
    """
    count, count_all = _counter(vocabulary)
    a = take(rpg, rec_id="rec_id", source=source_key(F.col("source_id")), language=language_key(F.col("language")), domain=F.col("metadata.category"), text="output")
    b = take(
        translator,
        rec_id="rec_id",
        source=source_key(F.col("source_id")),
        language=language_key(F.col("language")),
        domain=F.lit(None).cast("string"),
        texts=F.transform(turns("conversations"), lambda t: t["value"]),
    )
    return (
        a.withColumn("tokens", count("text")).drop("text").select(F.lit("rpg_dataset").alias("table_name"), "*")
        .unionByName(b.withColumn("tokens", count_all("texts")).drop("texts").select(F.lit("lora_translator").alias("table_name"), "*"))
    )


def budget(records: DataFrame, sources: DataFrame) -> DataFrame:
    """(table_name, source, language, domain, documents, tokens) of ``count_records``, one row per slice.

    Spellings of a source become its id in ``sources`` (``crawl_source``); an id that isn't there stays as folded, null stays
    null. A missing domain is that of the source in ``sources``. Sums are made before anything is looked up, so the join sees
    one row per slice; Spark broadcasts ``sources`` only if its own size check allows.
    """
    named = take(sources, key=source_key(F.col("source_id")), name="source_id", category="category").groupBy("key").agg(
        F.min("name").alias("name"), F.min("category").alias("category")
    )
    sums = records.groupBy("table_name", "source", "language", "domain").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    joined = sums.join(named, sums["source"] == named["key"], "left")
    return joined.groupBy(
        "table_name",
        F.coalesce("name", "source").alias("source"),
        "language",
        F.coalesce("domain", "category").alias("domain"),
    ).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
