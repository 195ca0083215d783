"""Keyed state kept by a stream of visits: each run takes what has arrived, merges it and stops or waits for more.

The state lies in buckets of keys. A version ``state-<batch>`` is one small file that names the folders of all buckets; a micro-batch
rewrites the buckets it touches and publishes its version by a rename, so a reader sees a whole state or the one before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import latest

BUCKETS = 16


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the published versions, in order."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(folder))]
    return sorted(int(n[6:]) for n in names if n.startswith("state-") and n[6:].isdigit())


def _manifest(spark: SparkSession, folder: str, number: int) -> dict[str, str]:
    return json.loads("".join(r[0] for r in spark.read.text(f"{folder}/state-{number}", wholetext=True).collect()))


def _publish(spark: SparkSession, folder: str, number: int, buckets: dict[str, str]) -> None:
    fs, path = _fs(spark, folder)
    beside = path(f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(buckets).encode()))
    out.close()
    if not fs.rename(beside, path(f"{folder}/state-{number}")):
        fs.delete(beside, False)


def merged(batch: DataFrame, number: int, key: str, order: list[str], values: list[str], folder: str, buckets: int = BUCKETS) -> None:
    """Publishes version ``number``: the newest earlier version with ``batch`` merged into the buckets that it touches.

    A version that is there already was published whole, from the same batch, and stays; a crash before the rename leaves the
    earlier version, from which a replay begins again. Folders that neither this version nor the one before names are removed.
    """
    spark = batch.sparkSession
    known = versions(spark, folder)
    if number in known:
        return
    before = max((n for n in known if n < number), default=None)
    paths = _manifest(spark, folder, before) if before is not None else {}
    columns = list(dict.fromkeys([key, *order, *values]))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    rows = batch.where(F.col(key).isNotNull()).select(*columns)
    touched = [r["bucket"] for r in rows.select(bucket).distinct().collect()]
    old = [paths[str(b)] for b in touched if str(b) in paths]
    if old:
        rows = rows.unionByName(spark.read.parquet(*[f"{folder}/{p}" for p in old]).select(*columns))
    if touched:
        part = f"data/{number}-{uuid.uuid4().hex}"
        last = latest(rows, key, order, *[c for c in columns if c != key])
        last.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/{part}")
        paths = paths | {str(b): f"{part}/bucket={b}" for b in touched}
    _publish(spark, folder, number, paths)
    kept = {p.split("/")[1] for n in (before, number) if n is not None for p in _manifest(spark, folder, n).values()}
    fs, path = _fs(spark, folder)
    if fs.exists(path(f"{folder}/data")):
        for f in fs.listStatus(path(f"{folder}/data")):
            if f.getPath().getName() not in kept:
                fs.delete(f.getPath(), True)
    for n in known:
        if before is not None and n < before:
            fs.delete(path(f"{folder}/state-{n}"), False)


def keep_latest(stream: DataFrame, key: str, order: list[str], values: list[str], folder: str, interval: str | None = None) -> StreamingQuery:
    """Merges each micro-batch into the state of ``folder``; without ``interval`` the query takes what there is and ends."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: merged(batch, number, key, order, values, folder))
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def current(spark: SparkSession, folder: str) -> tuple[DataFrame, str] | None:
    """The newest state and the path of its version; None before the first or while it holds no key."""
    known = versions(spark, folder)
    paths = sorted(_manifest(spark, folder, known[-1]).values()) if known else []
    return (spark.read.parquet(*[f"{folder}/{p}" for p in paths]), f"{folder}/state-{known[-1]}") if paths else None


def forget(spark: SparkSession, folder: str, key: str, keys: DataFrame) -> None:
    """Publishes the newest state without the keys of ``keys`` (a column of that name), so that they count as never seen."""
    now = current(spark, folder)
    if now is None:
        return
    number = versions(spark, folder)[-1]
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")
    left = now[0].join(keys.select(key).distinct(), key, "left_anti")
    part = f"data/{number}-{uuid.uuid4().hex}"
    left.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/{part}")
    fs, path = _fs(spark, folder)
    there = {f.getPath().getName() for f in fs.listStatus(path(f"{folder}/{part}"))}
    fs.rename(path(f"{folder}/state-{number}"), path(f"{folder}/before-{number}"))
    _publish(spark, folder, number, {n[7:]: f"{part}/{n}" for n in there if n.startswith("bucket=")})
    fs.delete(path(f"{folder}/before-{number}"), False)
