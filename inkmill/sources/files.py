"""Raw pages, JSON lines and reports on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip, word_count
from ..operators.report import dataset_type, record_format
from ..operators.split import train_val
from ..operators.state import file_name

SIDECAR = T.StructType(
    [
        T.StructField(name, kind)
        for kind, names in (
            (T.StringType(), "url source_id category extractor language display_name scraped_at output_file checksum_md5"),
            (T.LongType(), "http_status word_count char_count"),
            (T.ArrayType(T.StringType()), "tags"),
        )
        for name in names.split()
    ]
)


def raw_pages(spark: SparkSession, folder: str, category: str = "*") -> DataFrame:
    """Pages of ``folder/<category>/<source>/<name>.txt`` with the fields of their ``.json`` sidecars.

    Texts without a sidecar, blank texts and unreadable sidecars are left out. Only folders of the category are listed.
    """
    stem = lambda c: F.regexp_replace(c, r"\.(txt|json)$", "")
    texts = spark.read.text(f"{folder}/{category}/*/*.txt", wholetext=True).select(stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("text"))
    sides = spark.read.schema(SIDECAR).option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{folder}/{category}/*/*.json")
    sides = sides.select(stem(F.col("_metadata.file_path")).alias("stem"), *SIDECAR.names)
    return texts.where(strip(F.col("text")) != "").join(sides, "stem").where("url is not null")


def save_raw(pages: DataFrame, folder: str) -> None:
    """Pages with derived counts, checksum and file name, as Parquet in folders by category and source."""
    pages.select(
        "*",
        word_count(F.col("text")).alias("words"),
        F.length("text").alias("chars"),
        F.md5("text").alias("checksum"),
        file_name(F.col("url")).alias("name"),
    ).write.mode("append").partitionBy("category", "source_id").parquet(folder)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of JSON-lines files, blank lines included; parsing is up to the reader."""
    return spark.read.text(path).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), F.col("value").alias("line"))


def write_json_lines(records: DataFrame, path: str, fresh: bool = False) -> None:
    """Appends, or replaces what is there; letters beyond ASCII stay as they are."""
    records.write.mode("overwrite" if fresh else "append").json(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored state or snapshot; no rows if there is none yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def rewritten(spark: SparkSession, path: str, change) -> None:
    """Replaces the files of ``path`` by ``change`` of them, by two renames; a crash between them is made good by the next call.

    The old files are deleted only once the new ones stand in their place.
    """
    path = path.rstrip("/")
    at, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new", f"{path}.old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old):
        if fs.exists(at):
            fs.delete(old, True)
        else:
            fs.rename(old, at)
    change(spark.read.text(path)).write.mode("overwrite").text(f"{path}.new")
    fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, counted from 1; large files are read in many splits.

    Lines are counted by split, and only these counts are added up in order; no line is moved or sorted.
    """
    place = F.monotonically_increasing_id()
    raw = spark.read.text(path).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), F.col("_metadata.file_path").alias("at"),
        F.col("_metadata.file_block_start").alias("block"), place.alias("place"), F.col("value").alias("line"),
    )
    blocks = raw.groupBy("at", "block").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("at").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("at", "block", (ahead - F.col("first") + 1).alias("shift"))
    return raw.join(starts, ["at", "block"]).select("file", (F.col("place") + F.col("shift")).alias("line_no"), "line")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, format, error) of JSON-lines files.

    ``format`` is that of the first line of the file that has one; ``error`` is blank, bad_json or unknown for lines to be skipped.
    """
    lines = numbered_lines(spark, path)
    own = record_format(F.col("line"))
    seen = lines.withColumn("own", own)
    first = seen.where("own <> 'unknown'").groupBy("file").agg(F.min_by("own", "line_no").alias("format"))
    return seen.join(first, "file", "left").select(
        "file", "line_no", "line", F.coalesce("format", F.lit("unknown")).alias("format"),
        F.when(strip(F.col("line")) == "", "blank").when(F.col("own").isNull(), "bad_json").when(F.col("own") == "unknown", "unknown").alias("error"),
    )


def dataset_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, name, type, format, size, md5) of dataset files that match ``pattern``: the type by the name, the format by the first line."""
    whole = spark.read.format("binaryFile").load(pattern)
    head = F.split(F.decode("content", "UTF-8"), "\n")[0]
    return whole.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), dataset_type(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)).alias("type"),
        F.coalesce(record_format(head), F.lit("unknown")).alias("format"), F.col("length").alias("size"), F.md5("content").alias("md5"),
    )


def transferred(spark: SparkSession, files: DataFrame, overwrite: bool = False) -> DataFrame:
    """(path, to, md5, outcome) of copying files (path, to, md5), one by one on the driver, as there are few: transferred, exists or failed.

    A copy whose checksum differs is removed again.
    """
    jvm, out = spark._jvm, []
    conf, path = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path
    for r in files.select("path", "to", "md5").toLocalIterator():
        source, target = path(r["path"]), path(r["to"])
        fs = target.getFileSystem(conf)
        if fs.exists(target) and not overwrite:
            out.append((*r, "exists"))
            continue
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, target, False, True, conf)
        got = spark.read.format("binaryFile").load(r["to"]).select(F.md5("content")).first()[0]
        if got != r["md5"]:
            fs.delete(target, False)
        out.append((*r, "transferred" if got == r["md5"] else "failed"))
    return spark.createDataFrame(out, "path string, to string, md5 string, outcome string")


def export_split(records: DataFrame, key: str, folder: str, ratio: float = 0.9, seed: str = "42") -> None:
    """Training and validation sets as JSON lines in ``folder/train`` and ``folder/val``."""
    parts = train_val(records, key, ratio, seed)
    for part in ("train", "val"):
        parts.where(F.col("part") == part).drop("part").write.mode("overwrite").json(f"{folder}/{part}")


def save_snapshot(metrics: DataFrame, folder: str, timestamp: str) -> None:
    """Replaces ``folder/latest`` and appends a line of totals to ``folder/history``."""
    totals = metrics.agg(F.sum("valid_records").alias("total_records"), F.sum("bad_samples").alias("total_bad"), F.array_sort(F.collect_list("file")).alias("files"))
    metrics.write.mode("overwrite").parquet(f"{folder}/latest")
    totals.select(F.lit(timestamp).alias("timestamp"), "*").coalesce(1).write.mode("append").json(f"{folder}/history")
