import json

import pytest
from pyspark.sql import functions as F

from inkmill.operators import state
from inkmill.sources import files, html
from inkmill.streaming.state import current, forget, keep_latest


def test_urls(spark):
    urls = ["https://www.Some-Site.example.org/wiki/A/B c?x=1", "http://lore.fandom.com", "https://h/" + "p" * 100, None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    u = F.col("u")
    got = df.select(state.host(u).alias("h"), state.source_id_of(u).alias("s"), state.file_name(u).alias("n"), state.referer(u).alias("r")).collect()
    assert got[0][:] == ("www.some-site.example.org", "some_site", "wiki_A_B_c", "https://www.some-site.example.org/")
    assert got[1]["n"] == "lore_fandom_com" and got[1]["r"] == "https://lore.fandom.com/wiki/"
    assert len(got[2]["n"]) == 80 and got[3]["h"] is None


def test_crawl_decision(spark):
    visits = spark.createDataFrame(
        [("a", 304, 5, "m"), ("b", 200, 0, None), ("c", 200, 5, "m"), ("d", 200, 5, "n"), ("e", 200, 5, "m"), ("f", 200, 5, "m")], "url string, http_status int, words int, checksum string"
    )
    known = spark.createDataFrame([("c", "ok", "m"), ("d", "ok", "m"), ("e", "failed", "m")], "url string, status string, checksum string")
    got = {r["url"]: r["outcome"] for r in state.crawl_decision(visits, known).collect()}
    assert got == {"a": "unchanged", "b": "failed", "c": "unchanged", "d": "updated", "e": "stored", "f": "stored"}


def test_transfer_decision(spark):
    f = spark.createDataFrame([("a", "t", "1", False), ("b", "u", "1", False), ("c", "t", "1", True), ("d", "t", "2", False)], "path string, type_key string, md5 string, exists boolean")
    done = spark.createDataFrame([("a", "1"), ("d", "1")], "path string, md5 string")
    to = spark.createDataFrame([("t", "/x")], "type_key string, target string")
    assert {r[0]: r[1] for r in state.transfer_decision(f, done, to).collect()} == {"a": "done", "b": "no_target", "c": "exists", "d": "transfer"}
    assert {r[0]: r[1] for r in state.transfer_decision(f, done, to, overwrite=True).collect()}["c"] == "transfer"


def test_interleaved(spark):
    df = spark.createDataFrame([("http://a/1",), ("http://a/2",), ("http://b/1",)], "url string")
    rows = state.interleaved(df, "url", "url").orderBy("turn", "host").collect()
    assert [r["url"] for r in rows] == ["http://a/1", "http://b/1", "http://a/2"]


def test_raw_pages_and_json_lines(spark, tmp_path):
    at = tmp_path / "raw" / "trpg" / "src"
    at.mkdir(parents=True)
    for name, text, side in [("a", "line one\nline two", {"url": "http://x/a", "tags": ["t"]}), ("b", " \n", {"url": "http://x/b"}), ("c", "no side", None), ("d", "bad side", "{")]:
        (at / f"{name}.txt").write_text(text)
        if side is not None:
            (at / f"{name}.json").write_text(side if isinstance(side, str) else json.dumps(side))
    pages = files.raw_pages(spark, str(tmp_path / "raw"))
    assert [(r["text"], r["url"], r["tags"]) for r in pages.collect()] == [("line one\nline two", "http://x/a", ["t"])]
    out = str(tmp_path / "lines")
    rows = spark.createDataFrame([("é", 1)], "a string, b int")
    files.write_json_lines(rows, out)
    files.write_json_lines(rows, out)
    assert [r["line"] for r in files.json_lines(spark, out).collect()] == ['{"a":"é","b":1}'] * 2
    files.rewritten(spark, out, lambda x: x.distinct())
    assert files.json_lines(spark, out).count() == 1
    assert files.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    files.save_raw(spark.createDataFrame([("http://x/a", "t", "trpg", "src")], "url string, text string, category string, source_id string"), str(tmp_path / "saved"))
    assert spark.read.parquet(str(tmp_path / "saved")).first()["name"] == "a"


def test_html():
    page = "<nav><p>menu</p></nav><h2>Head</h2><p>One <b>bold</b><br>two<p>Three<script>var x = '</p>';</script></div>"
    assert html.text_of(page) == "Head\n\nOne bold two\n\nThree"
    wiki = '<div id="mw-content-text"><p>A long enough paragraph here.<sup>[1]</sup></p><p>short</p><table class="infobox"><tr><td><p>not this one at all, no</p></td></tr></table></div><p>outside of the container it is</p>'
    assert html.text_of(wiki, "mediawiki") == "A long enough paragraph here."
    assert html.text_of("<p>plain page</p>", "ao3") == "plain page"
    assert html.text_of(None) is None and html.text_of("") == ""
    assert html.text_of('<div class="chapter-content"><p>x</p></div><p>y</p>', "royalroad") == "x"


def test_links(one):
    assert one(html.links, '<a href="/a">x</a> <A class=k href=\'/b\'>y</A><a href="/a">z</a>') == ["/a", "/b"]


def test_stream_keeps_the_latest(spark, tmp_path):
    source, folder = str(tmp_path / "in"), f"file://{tmp_path}/state"
    write = lambda rows: spark.createDataFrame(rows, "k string, t int, v string").coalesce(1).write.mode("append").parquet(source)
    write([("a", 1, "x"), ("b", 5, "y")])
    schema = spark.read.parquet(source).schema
    run = lambda: keep_latest(spark.readStream.schema(schema).parquet(source), "k", ["t"], ["t", "v"], folder).awaitTermination()
    run()
    write([("a", 3, "z"), ("b", 2, "old"), (None, 9, "w")])
    run()
    assert {(r["k"], r["t"], r["v"]) for r in current(spark, folder)[0].collect()} == {("a", 3, "z"), ("b", 5, "y")}


def test_stream_replay(spark, tmp_path):
    """A batch whose commit was lost is taken again and leaves the same state, as does one that was never published."""
    folder, given = str(tmp_path / "state"), tmp_path / "in"
    given.mkdir()

    def arrive(name, *rows):
        (given / name).write_text("".join(json.dumps(dict(zip("ktv", r))) + "\n" for r in rows))
        stream = spark.readStream.schema("k string, t long, v string").json(str(given))
        keep_latest(stream, "k", ["t"], ["v"], folder).awaitTermination()

    def state_now():
        return {(r["k"], r["t"], r["v"]) for r in current(spark, folder)[0].collect()}

    arrive("1.json", ("a", 1, "x"), ("b", 1, "y"))
    arrive("2.json", ("b", 2, "z"), ("c", 1, "w"))
    want = {("a", 1, "x"), ("b", 2, "z"), ("c", 1, "w")}
    assert state_now() == want
    for lose_version in (False, True):
        (tmp_path / "state/checkpoint/commits/1").unlink()
        (tmp_path / "state/checkpoint/commits/.1.crc").unlink(missing_ok=True)
        if lose_version:
            (tmp_path / "state/state-1").unlink()
            (tmp_path / "state/.state-1.crc").unlink(missing_ok=True)
        keep_latest(spark.readStream.schema("k string, t long, v string").json(str(given)), "k", ["t"], ["v"], folder).awaitTermination()
        assert state_now() == want
    arrive("3.json", ("a", 0, "old"), ("d", 1, "q"))
    assert state_now() == want | {("d", 1, "q")}
    forget(spark, folder, "k", spark.createDataFrame([("a",), ("d",)], "k string"))
    assert state_now() == {r for r in want if r[0] != "a"}


def test_lines_records_and_transfer(spark, tmp_path):
    sound = json.dumps({"instruction": "i", "output": "o"})
    (tmp_path / "rpg_dataset.jsonl").write_text("\n".join(["", "{bad", json.dumps({"x": 1}), sound, json.dumps({"prompt": 1, "chosen": 2})]) + "\n")
    (tmp_path / "big.jsonl").write_text("".join(f"line {i}\n" for i in range(1, 30001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert files.numbered_lines(spark, str(tmp_path / "big.jsonl")).where("line <> concat('line ', line_no)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted(tuple(r) for r in files.records(spark, str(tmp_path / "rpg*.jsonl")).select("line_no", "format", F.coalesce("error", F.lit(""))).collect())
    assert got == [(1, "alpaca", "blank"), (2, "alpaca", "bad_json"), (3, "alpaca", "unknown"), (4, "alpaca", ""), (5, "alpaca", "")]
    found = files.dataset_files(spark, str(tmp_path / "*.jsonl")).collect()
    assert {(r["name"], r["type"]) for r in found} == {("rpg_dataset.jsonl", "rpg_dataset"), ("big.jsonl", "unknown")}
    big = next(r for r in found if r["name"] == "big.jsonl")
    for md5, overwrite, want in ((big["md5"], False, "transferred"), (big["md5"], False, "exists"), ("0", True, "failed")):
        rows = spark.createDataFrame([(big["path"], str(tmp_path / "to/big.jsonl"), md5)], "path string, to string, md5 string")
        assert files.transferred(spark, rows, overwrite).collect()[0]["outcome"] == want
    assert not (tmp_path / "to/big.jsonl").exists()


def test_rewrite_survives_a_crash(spark, tmp_path):
    at = tmp_path / "d"
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(str(at))
    at.rename(tmp_path / "d.old")  # as after a crash between the renames
    files.rewritten(spark, str(at), lambda df: df.where("value <> 'a'"))
    assert [r[0] for r in spark.read.text(str(at)).collect()] == ["b"] and not (tmp_path / "d.old").exists()


@pytest.mark.parametrize(
    ("site", "page", "want"),
    [
        ("lexicanum", '<div id="mw-content-text"><p>Sources agree that the gate was shut.[1]</p><p>It stayed so for seven winters.</p><h2>Sources and other things</h2><p>They named it the quiet gate then.</p></div>', "Sources agree that the gate was shut.\n\nIt stayed so for seven winters.\n\nSources and other things\n\nThey named it the quiet gate then."),
        ("fandom", '<div class="mw-parser-output"><aside class="portable-infobox"><p>An infobox that is long enough.</p></aside><div class="thumb"><p>A caption that is long enough.</p></div><p>The body of the page is here.</p></div>', "The body of the page is here."),
        ("mediawiki", '<div id="mw-content-text"><table class="wikitable"><tr><td><p>A table cell that is long enough.</p></td></tr></table><p>The body of the page<sup>1</sup> is here.</p></div>', "The body of the page is here."),
        ("ao3", '<dl class="work meta"><p>meta</p></dl><div class="userstuff"><p>Story.</p><div id="kudos"><p>kudos</p></div></div>', "Story."),
        ("royalroad", '<div class="chapter-content"><p>One.</p><div class="author-info"><p>by</p></div></div>', "One."),
        ("syosetu", '<div class="p-novel_view"><p>本文</p></div><p>外</p>', "本文"),
        ("kakuyomu", '<div class="episode-body"><p>本文</p></div><p>外</p>', "本文"),
        ("kakuyomu", "<p>外</p>", "外"),
    ],
)
def test_rules_by_site(site, page, want):
    assert html.text_of(page, site) == want


def test_extracted_pages(spark):
    rows = [("u", "generic", "<h2>Head</h2><p>ﬁve  words\n are here</p><nav><p>x</p></nav>"), ("v", None, ""), ("w", "ao3", None)]
    got = html.pages(spark.createDataFrame(rows, "url string, extractor string, html string")).collect()
    assert [r["url"] for r in got] == ["u"] and got[0]["word_count"] == 5 and got[0]["char_count"] == len(got[0]["text"])
