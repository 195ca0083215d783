import json

from inkmill.__main__ import main
from inkmill.functions.fixed import PENDING
from inkmill.operators import fill, report
from inkmill.sources import files


def test_fill_is_taken_up_again(spark):
    schema = "rec_id long, prompt string, chosen array<struct<from string, value string>>"
    rows = [(1, "q1", [("system", "s"), ("gpt", PENDING)]), (2, "q2", [("gpt", "done")]), (3, None, [("gpt", PENDING)]), (4, "q4", None), (5, "q5", [("gpt", PENDING + " x")])]
    df = spark.createDataFrame(rows, schema)

    def client():
        return lambda system, prompt: f"{system}:{prompt}"

    first = fill.filled(df, client, limit=1)
    assert [tuple(r) for r in first.collect()] == [(1, "s:q1")]
    assert [tuple(r) for r in fill.filled(df, client, done=first).collect()] == [(3, ":")]


def test_report_and_snapshot(spark, tmp_path):
    rows = [("a.jsonl", "alpaca", "x", "s", "en", False, True)] * 3 + [("a.jsonl", "alpaca", "just a moment", "s", "en", False, True), ("a.jsonl", "alpaca", "", "s", "en", False, False)]
    m = report.file_metrics(spark.createDataFrame(rows, "file string, format string, text string, source string, language string, pending boolean, valid boolean"))
    got = m.first()
    assert (got["total_lines"], got["valid_records"], got["format_errors"], got["bad_samples"], got["exact_dups"], got["word_count_max"]) == (5, 4, 1, 1, 2, 3)
    text = report.markdown(report.health_status(m), report.delta(m, m, "file", "bad_samples"))
    assert "| a.jsonl |" in text and "drop_sources" in text
    files.save_snapshot(m, str(tmp_path), "t1")
    files.save_snapshot(m, str(tmp_path), "t2")
    assert spark.read.json(f"{tmp_path}/history").count() == 2 and spark.read.parquet(f"{tmp_path}/latest").count() == 1
    files.export_split(spark.range(10), "id", str(tmp_path / "split"), 0.8)
    assert (spark.read.json(f"{tmp_path}/split/train").count(), spark.read.json(f"{tmp_path}/split/val").count()) == (8, 2)


def test_command_line(spark, tmp_path):
    prose = "\n\n".join(" ".join(f"word{i}x{k}" for k in range(100)) + " tower." for i in range(4))
    for category, source, language in (("trpg", "a", "en"), ("webnovel", "b", "en"), ("multilingual_lore", "c", "fr")):
        at = tmp_path / "raw" / category / source
        at.mkdir(parents=True)
        (at / "p.txt").write_text(prose.replace("tower", f"{category} tower"))
        (at / "p.json").write_text(json.dumps({"url": f"http://x/{category}", "category": category, "source_id": source, "language": language, "tags": ["en"]}))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    main(["build", "--raw", raw, "--out", out, "--fresh", "--max-words", "120"])
    assert spark.read.json(f"{out}/rpg_dataset").count() == 8 and spark.read.json(f"{out}/literature_dataset").count() == 4
    main(["stories", "--raw", raw, "--out", out, "--fresh", "--max-words", "120"])
    assert spark.read.json(f"{out}/lora_storyteller").count() == 6
    main(["translate", "--raw", raw, "--out", out, "--fresh", "--max-words", "120"])
    assert {r["target_language"] for r in spark.read.json(f"{out}/lora_translator").collect()} == {"en", "fr"}
