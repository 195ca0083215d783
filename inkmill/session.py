"""Session settings and the two small services every plan may need."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "inkmill") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("INKMILL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where a session on one machine names none, as in tests, a fresh folder is made and named in the session; on a cluster that is
    an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="inkmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage.

    The files survive the loss of any executor, unlike cached or locally checkpointed blocks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, most_bytes: int = 4 << 30) -> DataFrame:
    """``df`` over all cores if it lies in fewer splits than half of them, as one small file does; else as it is.

    For tables that Python or regexes work on for long. Only tables of at most ``most_bytes`` by the optimizer's estimate are moved;
    projections and filters are pushed below the exchange.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > most_bytes:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() * 2 <= cores else df
