import random

import pytest
from pyspark.sql import functions as F

from inkmill.functions.fixed import STATUS
from inkmill.operators import report, split


@pytest.mark.parametrize("n", [1, 2, 3, 4, 97])
def test_nearest_rank(spark, n):
    values = [random.Random(n).randrange(20) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    got = report.nearest_rank(df, "v", [], (25, 50, 75, 95)).first()
    s = sorted(values)
    assert [got[f"p{p}"] for p in (25, 50, 75, 95)] == [s[min(n * p // 100, n - 1)] for p in (25, 50, 75, 95)]


def metrics(spark, **x):
    row = {"file": "f", "format": "alpaca", "valid_records": 100, "bad_samples": 0, "exact_dups": 0, "needs_generation": 0, "word_count_median": 50} | x
    return report.health_status(spark.createDataFrame([row], "file string, format string, valid_records long, bad_samples long, exact_dups long, needs_generation long, word_count_median long"))


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ({}, "healthy"), ({"valid_records": 0}, "empty"), ({"bad_samples": 10}, "warn"), ({"bad_samples": 11}, "danger"), ({"bad_samples": 3}, "healthy"),
        ({"exact_dups": 20}, "warn"), ({"exact_dups": 21}, "danger"), ({"valid_records": 49}, "warn"), ({"word_count_median": 19}, "warn"),
        ({"file": "lora_analyst.jsonl", "word_count_median": 3}, "healthy"), ({"format": "dpo", "needs_generation": 100}, "waiting"), ({"format": "dpo", "needs_generation": 99}, "healthy"),
    ],
)
def test_health_status(spark, given, want):
    assert metrics(spark, **given).first()["status"] == STATUS[want]


def test_suggestions_and_delta(spark):
    got = [r["suggestion"] for r in report.suggestions(metrics(spark, valid_records=20, bad_samples=5, exact_dups=2)).collect()]
    assert got == ["drop_sources", "dedup", "more_records"]
    a, b = (spark.createDataFrame(x, "k string, n int") for x in ([("x", 3), ("y", 1)], [("x", 5)]))
    assert {(r["k"], r["change"], r["trend"]) for r in report.delta(a, b, "k", "n").collect()} == {("x", -2.0, "↓"), ("y", None, None)}


def test_formats_and_errors(spark):
    lines = ['{"instruction": 1, "output": "x", "metadata": {}}', "", "{", '{"output": ""}', '{"instruction": 1, "output": " ", "metadata": 1}', "[1, 2]"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r["line"]: r["error"] for r in report.record_errors(df).collect()}
    assert [got[x] for x in lines] == [None, "blank", "bad_json", "missing_field", "blank_output", "bad_json"]
    kinds = df.select(report.record_format(F.col("line")).alias("f")).collect()
    assert [r["f"] for r in kinds] == ["alpaca", None, None, "unknown", "alpaca", None]
    stems = spark.createDataFrame([("LoRA_Analyst_cleaned",), ("x",)], "s string").select(report.dataset_type(F.col("s")).alias("t"))
    assert [r["t"] for r in stems.collect()] == ["lora_analyst", "unknown"]


@pytest.mark.parametrize(("n", "ratio"), [(1, 0.5), (2, 0.9), (10, 0.9), (1000, 0.99)])
def test_split_sizes(spark, n, ratio):
    parts = split.train_val(spark.range(n), "id", ratio)
    assert parts.count() == n
    assert parts.where("part = 'train'").count() == max(1, int(n * ratio))
    assert split.train_val(spark.range(0), "id").count() == 0
    assert split.sample(spark.range(n), "id", 3).count() == min(n, 3)


def test_breakdown_as_maps(spark):
    rows = [("f", "alpaca", "lorem ipsum", "a", "en", False, True), ("f", "alpaca", "fine words", "b", None, False, True), ("f", "alpaca", "fine words", "b", "fr", False, True), ("f", "alpaca", "", None, "en", False, False)]
    df = spark.createDataFrame(rows, "file string, format string, text string, source string, language string, pending boolean, valid boolean")
    parts = report.breakdown(report.counted_texts(df))
    got = report.as_maps(parts).first()
    assert got["by_source"] == {"b": 2, "a": 1} and got["by_language"] == {"en": 1, "fr": 1, "unknown": 1}
    assert set(got["bad_sources"]) == {r["source"] for r in report.worst_sources(parts).collect()}
    m = report.file_metrics(df).first()
    assert (m["total_lines"], m["valid_records"], m["format_errors"], m["exact_dups"]) == (4, 3, 1, 1)
    assert report.file_metrics(df.limit(0)).count() == 0
