"""Problem 7: copies hidden by formatting, by recursive radix partitioning on canonical bytes and counting tries."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .columns import take, turns
from .text import canonical, h128

LEAST_CHARS = 20


@F.pandas_udf(T.BinaryType())
def canonical_bytes(texts: pd.Series) -> pd.Series:
    """Canonical UTF-8 bytes of each text; null if it has fewer than 20 letters and digits."""
    found = (canonical(t) if isinstance(t, str) else "" for t in texts)
    return pd.Series([x.encode("utf-8", "replace") if len(x) >= LEAST_CHARS else None for x in found], dtype=object)


@F.pandas_udf(T.BinaryType())
def canonical_turns(conversations: pd.Series) -> pd.Series:
    """The same for arrays of (role, value): the turns are put in one order, each with its role before it."""

    def one(conversation) -> bytes | None:
        each = [(t["role"].strip().lower(), canonical(t["value"])) for t in conversation]
        if sum(len(x) for _, x in each) < LEAST_CHARS:
            return None
        return "\n".join(sorted(f"{r}\t{x}" for r, x in each)).encode("utf-8", "replace")

    return pd.Series([one(c) for c in conversations], dtype=object)


class Trie:
    """A burst trie over bytes, with a list of ids at each terminal; nodes branch on ``stride`` bytes, leaves keep the rest."""

    def __init__(self, stride: int = 8):
        self.root: dict = {}
        self.stride = stride
        self.terminals: list[tuple[bytes, list[int]]] = []

    def add(self, key: bytes, item: int) -> None:
        node, at, step = self.root, 0, self.stride
        while True:
            part = key[at : at + step]
            at += step
            below = node.get(part)
            if below is None:
                node[part] = (key[at:], len(self.terminals))
                self.terminals.append((key, [item]))
                return
            if isinstance(below, tuple):
                rest, terminal = below
                if rest == key[at:]:
                    self.terminals[terminal][1].append(item)
                    return
                # two keys share this branch: the leaf moves down into a node of its own; the empty part marks its end
                below = node[part] = {rest[:step]: (rest[step:], terminal)}
            node = below


def _oversized(rows: DataFrame, most: int) -> list[tuple[int, DataFrame]]:
    """(depth, prefixes) of the buckets with more than ``most`` rows, level by level, until no bucket can be split further."""
    levels: list[tuple[int, DataFrame]] = []
    depth, open_rows = 2, rows
    while True:
        prefix = F.substring("bytes", 1, depth)
        heavy = (
            open_rows.groupBy(prefix.alias("prefix"))
            .agg(F.count("*").alias("n"), F.max(F.length("bytes")).alias("longest"))
            .where(F.col("n") > most)
        )
        heavy = stored(heavy, "radix")
        state = heavy.agg(F.count("*").alias("n"), F.max("longest").alias("longest")).first()
        if not state["n"]:
            return levels
        levels.append((depth, heavy.select("prefix", "n", (F.col("longest") <= depth).alias("whole"))))
        if state["longest"] <= depth:
            return levels
        open_rows = open_rows.join(heavy.where(F.col("longest") > depth).select(F.col("prefix").alias("p")), prefix == F.col("p"), "left_semi")
        depth *= 2


def classes(rows: DataFrame, key: str = "rec_id", data: str = "bytes", bucket_rows: int = 50_000) -> DataFrame:
    """(key, class_id, copies): for each row with canonical bytes, the smallest key among its copies and their number.

    Buckets are prefixes of the bytes. A bucket of more than ``bucket_rows`` rows is split by twice as many bytes, again and
    again; one that can't be split, as all its texts are the same, is a hot class: its rows are spread by a salt, counted in
    several tries, and the terminal counters of these are added up. Null keys and null bytes are left out, repeated rows count
    as copies, ties take the smallest key. A task holds the trie of one bucket at a time, of at most ``bucket_rows`` rows
    or about so many of a salted one.
    """
    rows = stored(take(rows, id=F.col(key).cast("long"), bytes=data).where("id is not null and bytes is not null"), "canonical")
    levels = _oversized(rows, bucket_rows)
    bucketed = rows.withColumn("depth", F.lit(2)).withColumn("salts", F.lit(0))
    for depth, heavy in levels:
        found = heavy.select(F.col("prefix").alias("p"), F.when(F.col("whole"), F.ceil(F.col("n") / bucket_rows)).otherwise(0).cast("int").alias("s"))
        at = F.when(F.col("depth") == depth, F.substring("bytes", 1, depth))
        bucketed = (
            bucketed.join(found, at == F.col("p"), "left")
            .withColumn("depth", F.when(F.col("p").isNotNull() & (F.col("s") == 0), F.lit(depth * 2)).otherwise(F.col("depth")))
            .withColumn("salts", F.when(F.col("s") > 0, F.col("s")).otherwise(F.col("salts")))
            .drop("p", "s")
        )
    prefix = F.expr("substring(bytes, 1, depth)")
    salt = F.when(F.col("salts") > 0, F.pmod(F.xxhash64("id"), F.col("salts"))).otherwise(F.lit(0))
    spread = bucketed.select("id", "bytes", (F.col("salts") > 0).alias("hot"), F.xxhash64(prefix, salt).alias("bucket"))
    spread = spread.repartition("bucket").sortWithinPartitions("bucket")

    def counters(trie: Trie, hot: set[bytes]) -> Iterator[tuple]:
        for text, ids in trie.terminals:
            least, n, of = min(ids), len(ids), h128(text) if text in hot else None
            for k, i in enumerate(ids):
                yield i, least, n, of, k == 0

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One trie at a time: rows come sorted by bucket, and a bucket's trie is given away when the next one begins."""
        trie, hot, now, out = Trie(), set(), None, []
        for batch in batches:
            for i, b, h, bucket in zip(batch["id"], batch["bytes"], batch["hot"], batch["bucket"]):
                if bucket != now:
                    out += counters(trie, hot)
                    trie, hot, now = Trie(), set(), bucket
                trie.add(b := bytes(b), i)
                if h:
                    hot.add(b)
            yield pd.DataFrame(out, columns=["id", "least", "n", "hot", "first"])
            out = []
        yield pd.DataFrame(counters(trie, hot), columns=["id", "least", "n", "hot", "first"])

    counted = spread.mapInPandas(count, "id long, least long, n long, hot binary, first boolean")
    if any(heavy.where("whole").limit(1).count() for _, heavy in levels):
        counted = stored(counted, "counted")
        total = counted.where("hot is not null and first").groupBy(F.col("hot").alias("h")).agg(F.min("least").alias("l"), F.sum("n").alias("t"))
        counted = counted.join(total, F.col("hot") == F.col("h"), "left").select(
            "id", F.coalesce("l", "least").alias("least"), F.coalesce("t", "n").alias("n")
        )
    return counted.select(F.col("id").alias(key), F.col("least").alias("class_id"), F.col("n").alias("copies"))


def canonical_rows(*tables: tuple[DataFrame, str, str]) -> DataFrame:
    """(rec_id, bytes) of several (table, key, column), a column being a text or a conversation; tables never mix."""
    parts = []
    for number, (table, key, column) in enumerate(tables):
        if dict(table.dtypes)[column] == "string":
            made = canonical_bytes(F.col(column))
        else:
            made = canonical_turns(turns(column))
        part = take(table, rec_id=key, made=made)
        tag = F.lit(bytes([number]))
        parts.append(part.select("rec_id", F.when(F.col("made").isNotNull(), F.concat(tag, F.col("made"))).alias("bytes")))
    return reduce(DataFrame.unionByName, parts)


def pairs(found: DataFrame) -> DataFrame:
    """(rec_id_a, rec_id_b): of each class of two or more, its smallest key with every other one."""
    return found.where("rec_id <> class_id").select(F.col("class_id").alias("rec_id_a"), F.col("rec_id").alias("rec_id_b")).distinct()
