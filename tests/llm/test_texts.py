import random

import numpy as np
import pytest

from inkmill.llm import answers, caps, leaks, pages, quality, repetition, residue
from inkmill.llm.text import WORD, fold, is_cjk, squeeze

PROSE = "The keeper of the old mill told the travellers that the river had never run so low. Nobody in the village believed it, and the miller laughed. "


# -- residue -----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("text", "want"),
    [
        (PROSE * 8 + "{{place}}", "slot"), (PROSE + "led %s to the gate", "slot"), (PROSE + "by [INSERT TOWN NAME] here", "slot"), ("walk from undefined to the mill. " + PROSE, "slot"),
        (PROSE * 3 + "【此处填写姓名】", "slot"), ("Lorem ipsum dolor sit amet, labore magna aliqua ut enim ad minim veniam.", "filler"), ("Text for Mira goes here. Draft 12ab34cd56.", "filler"),
        ("Mill Archive\n\n404 Not Found | the requested URL /a/b was not found on this server.", "error"), ('{"success": false, "reason": "not_found"}', "error"),
        ("Traceback (most recent call last):\n  File \"/a.py\", line 3\nKeyError: 'x'", "error"), ("Please enable JavaScript to view /a/b.", "script"), ("/a を表示するには JavaScript を有効にしてください。", "script"),
        ("访问被拒绝，事件编号 15565f794f", "error"), (PROSE * 4, None), ("See [[Old Mill]] for the spelling [sic] of the oath.[1] " + PROSE, None),
        (PROSE + PROSE + "The clerk stopped at 404 sacks, not found wanting, and signed.", None), ('{"name": "Mira", "age": 404, "kind": "x"}', None), ("", None), ("  ", None), (None, None),
        ("Roll [2d6+3] for the 【Mira】 and the {\"a\": 1}", None),
    ],
)
def test_kind(text, want):
    assert residue.kind(text) == want


def test_residue_over_tables(spark):
    meta = "rec_id long, output string, metadata struct<source_id string>, kind string"
    weak = [(i, f"Incident {i:08d}ab, we failed.", (f"s{i}",), "x") for i in range(3)]
    a = spark.createDataFrame([(10, "Please enable JavaScript to view /x.", None, "k"), (11, None, None, "k"), (None, "{{a}}", None, "k"), (12, PROSE, ("s",), "k")] + weak, meta)
    b = spark.createDataFrame([(20, "{{a}} " + PROSE, ("s",), "k"), (20, "{{a}} " + PROSE, ("s",), "k")], meta)
    got = sorted(tuple(r) for r in residue.residue(a, b).collect())
    assert got == [(0, "error"), (1, "error"), (2, "error"), (10, "script"), (20, "slot"), (20, "slot")]
    assert residue.residue(a.limit(0), b.limit(0)).count() == 0


# -- answers -----------------------------------------------------------------------------------------------------------
Q = "What does Mira want from the people of the mill?"


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        (Q, None, "empty"), (Q, " ​　", "empty"), (Q, "<p></p>", "empty"), (Q, "N/A.", "empty"), (Q, "&nbsp;", "empty"), (Q, "—", "empty"),
        (Q, "I'm sorry, but I can't help with a request about Mira.", "refusal"), (Q, "很抱歉，我无法回答关于米拉的请求。", "refusal"), (Q, "Als KI-Sprachmodell kann ich das leider nicht.", "refusal"),
        (Q, '"I\'m sorry, but I can\'t help you," Mira told the party. ' + PROSE * 4, None), (Q, "You asked: " + Q, "copy"), (Q, Q.upper() + "\n" + Q, "copy"), (Q, Q + " " + PROSE, None),
        (Q, "Nadie en la villa sabía que el molino era de la viuda, y el río corría bajo la nieve hasta que el abad lo vio.", "language"), ("Describe in Spanish how Mira came to the mill.", PROSE, "language"),
        ("Describe in Spanish how Mira came to the mill.", "Nadie en la villa sabía que el molino era de la viuda, y el río corría bajo la nieve hasta que el abad lo vio.", None),
        (Q, PROSE + "There are 12 steps between the mill and the", "truncated"), (Q, PROSE + "Nobody knew that Mira guar", "truncated"), (Q, '{"name": "Mira", "notes": "She ', "truncated"), (Q, PROSE + "Mira saw it, and the,", "truncated"),
        (Q, PROSE + "\n\n— from the annals of the mill, vol. 4", None), (Q, PROSE + "\n\n(to be read aloud to the party)", None), (Q, PROSE + "\nLoot: 7 silver, a rope", None), (Q, "no marks at all in a text that was stripped of them", None),
        (Q, PROSE, None), (None, PROSE, None), (Q, "Mira Stone.", None), (Q, "{{name}} waits", None), (Q, PROSE + '\n\n"Then let it burn," Mira said, and smiled', "open"),
    ],
)
def test_defect(question, answer, want):
    assert answers.defect(question, answer) == want


def test_defects_with_neighbours_and_odd_rows(spark):
    whole = PROSE + "\n\nThen the warden of the valley rode out at dawn and saw the smoke"
    schema = "id long, question string, answer string"
    rows = [(1, Q, whole), (2, Q, whole + " above the mill and turned back."), (3, Q, PROSE + "\n\nAnother ending without a mark"), (4, Q, None), (None, Q, None), (5, None, "")]
    got = {tuple(r) for r in answers.defects(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "truncated"), (4, "empty"), (5, "empty")}
    assert answers.defects(spark.createDataFrame([], schema)).count() == 0


def test_shortened_across_partitions(spark):
    rows = [(i, f"text number {i:04d} " + "x" * 30, True) for i in range(200)] + [(1000 + i, f"text number {i:04d} " + "x" * 30 + " more", False) for i in range(0, 200, 2)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r["id"] for r in answers.shortened(spark.createDataFrame(rows, "id long, form string, open boolean")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == set(range(0, 200, 2))


def test_last_exchange(spark):
    conv = "rec_id long, conversations array<struct<from string, value string>>, question string"
    rows = [(1, [("human", "a"), ("gpt", "b"), ("human", "c"), ("gpt", "d")], "x"), (2, [("human", "a")], "x"), (3, None, "x"), (4, [("gpt", "b")], "x"), (5, [("gpt", "b"), ("human", "a")], "x"), (6, [], "x")]
    got = {r["id"]: (r["question"], r["answer"]) for r in answers.last_exchange(spark.createDataFrame(rows, conv)).collect()}
    assert got == {1: ("c", "d"), 2: ("a", None), 3: (None, None), 4: (None, "b"), 5: ("a", None), 6: (None, None)}


# -- pages -------------------------------------------------------------------------------------------------------------
PAGE = f"""Skip to main content
Help · Forum · Timeline · Log in
Forum / Help / Old Mill
We use cookies to improve your experience. Accept all | Manage

Old Mill
{PROSE}
Advertisement
Geography
{PROSE}
- a map of the mill
Spear | 1d6 | 4 silver
All rights of passage are reserved to the Wardens.
The halfling cookies of the mill are sold at dawn.
{PROSE}
Related pages: Mira, Roland
Back to top
© 2020 Mill Wiki contributors. All rights reserved."""


def test_furniture():
    assert pages.furniture_lines(PAGE) == [1, 2, 3, 4, 8, 16, 17, 18]
    assert pages.furniture_lines(PROSE) == pages.furniture_lines(None) == pages.furniture_lines("") == []
    assert pages.furniture_lines(PROSE + "\n\n" + PROSE + "\nHistory\n" + PROSE) == []


def test_furniture_over_a_table(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, PROSE), (4, PAGE + "\n{{slot}}")], "rec_id long, output string")
    assert sorted(tuple(r) for r in pages.furniture(df).collect()) == [(1, n) for n in (1, 2, 3, 4, 8, 16, 17, 18)]
    text = df.select("rec_id", pages.body("output").alias("b")).collect()
    assert text[0]["b"].startswith("\nOld Mill".strip("\n")) and "cookies to improve" not in text[0]["b"] and text[1]["b"] is None and text[2]["b"] == PROSE


# -- leaks -------------------------------------------------------------------------------------------------------------
def test_leaks_as_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(20)] + [(90, "霧の中で鍛冶屋は鐘を七つ鳴らし、" * 4), (91, None), (92, "")]
    docs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=60)
        item = rng.choice(items[:20])[1].split()
        n, at = rng.randrange(10, 22), rng.randrange(15)
        words[20 : 20 + n] = [w.upper() + rng.choice([",", "", "!"]) for w in item[at : at + n]]
        docs.append((i, " ".join(words)))
    docs += [(500, None), (501, ""), (502, "abc 霧の中で鍛冶屋は鐘を七つ鳴らし" * 4), (None, items[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame(items, "item_id long, text string")

    def meets(text, passage):
        char = is_cjk(passage)
        a, b = ((squeeze(x), 40) if char else (" " + " ".join(WORD.findall(fold(x))) + " ", 15) for x in (text, passage))
        parts = b[0] if char else b[0].split()
        run = b[1]
        return any((parts[k : k + run] if char else " " + " ".join(parts[k : k + run]) + " ") in a[0] for k in range(len(parts) - run + 1))

    want = {(i, j) for i, t in docs for j, p in items if t and p and meets(t, p)}
    for block in (8_000_000, 300):
        got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked(leaks.overlaps(d, e, block_chars=block)).collect()}
        assert got == want and len(want) > 20
    assert leaks.overlaps(d.limit(0), e).count() == leaks.overlaps(d, e.limit(0)).count() == 0


def test_substitutions_are_tolerated_around_hits():
    words = [f"w{i}" for i in range(40)]
    other = words.copy()
    other[2] = "changed"  # under a zero of the first mask
    found = leaks.Index([(1, " ".join(words[:15]))]).find(" ".join(other[:15]))
    assert found and found[0][1] == 12 and found[0][2] == pytest.approx(14 / 15)


# -- repetition --------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("text", "over"),
    [(PROSE * 4, True), (PROSE, False), ("", False), ("word " * 50, True), ("\n".join(f"{i}. The gate of {n} is shut and the warden sleeps" for i, n in enumerate("Ada Bo Cy Di Ed Flo".split())), True),
     ("无底的果园寡妇的书库" * 20, True), ("霧の中で鍛冶屋は鐘を七つ鳴らした。川のほとりで老婆が笑っていた。", False), (" ".join(f"w{i}" for i in range(400)), False)],
)
def test_share(text, over):
    assert (repetition.share(text) > repetition.LIMIT) is over


def test_forest_sets_odd_rows_apart():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (600, 4)), np.full((6, 4), 9.0) + rng.normal(0, 0.1, (6, 4))])
    paths = repetition.Forest(rows).paths(rows)
    assert paths[600:].max() < np.median(paths[:600])


def test_repetition_over_a_table(spark):
    rng = random.Random(2)
    fresh = [(i, " ".join(rng.choices([f"w{k}" for k in range(900)], k=150)) + ".") for i in range(300)]
    again = [(1000 + i, (" ".join(rng.choices([f"w{k}" for k in range(900)], k=12)) + ". ") * 12) for i in range(25)]
    df = spark.createDataFrame(fresh + again + [(5000, None), (5001, ""), (None, PROSE)], "doc_id long, text string").withColumnRenamed("x", "share")
    rows = repetition.repetition(df).collect()
    assert {r["doc_id"] for r in rows if r["share"] and r["share"] > repetition.LIMIT} == {i for i, _ in again}
    assert len(rows) == 328 and repetition.repetition(df.limit(0)).count() == 0


def test_every_document_has_its_exact_share(spark):
    """Also one of a kind that the fitted sample doesn't hold, and with a longer path than those it holds."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(900)]
    fresh = [(i, " ".join(rng.choices(vocabulary, k=150)) + ".") for i in range(200)]
    odd = [(500 + i, "word " * 50) for i in range(20)]
    half = [(1000 + i, " ".join((a := rng.choices(vocabulary, k=75)) + a)) for i in range(20)]
    rows = fresh + odd + half
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (8, 60, repetition.SAMPLE):
        got = {r["doc_id"]: r["share"] for r in repetition.repetition(df, sample=sample).collect()}
        assert got == {i: repetition.share(t) for i, t in rows}


# -- quality and caps --------------------------------------------------------------------------------------------------
GOOD = "Mira counted the lanterns along the wall of {0} and told the miller that the river had run dry. Nobody in {0} believed her until the bridge fell, and then it was too late for the {1}. "
MORE = "Twelve barges lay at the quay of {0} that winter, because the toll had doubled. Every ferryman swore that the {1} would pay for it before the thaw. "


def test_quality():
    sound = GOOD.format("Orle", "herd") + MORE.format("Tave", "abbot")
    assert quality.score(Q, sound) > 0.9
    assert quality.score("In one line: who rules Orle?", "Mira Stone.") > 0.9 > quality.SOUND > quality.score(Q, "Mira Stone.")
    for bad in ("lol yeah ok pls nerf", "A=1 B=2 C=3 D=4 E=5 F=6 G=7", sound.upper() + "!!!!!", PROSE * 6, "stone mill lantern river bridge gate tower warden keeper miller abbot herald", None, "", Q, "Orla, Tave, Mira, Roland, Ada, Bo, Cy, Di, Ed"):
        assert quality.score(Q, bad) < quality.SOUND


def test_cap_keeps_the_best_of_every_stratum(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):  # the hot contributor, in several spellings
        good = i % 10 == 0
        text = GOOD.format(f"Orle{i}", f"herd{i}") + MORE.format(f"Tave{i}", "abbot") if good else rng.choice(["lol ok pls", "", None, "A=1 B=2 C=3 D=4 E=5 F=6"])
        rows.append((i, rng.choice(["big_one", "Big One", " BIG-ONE"]), i % 3, Q, text))
    rows += [(1000 + i, f"s{i % 70}", None, Q, PROSE) for i in range(690)] + [(5000 + i, None, 1, Q, PROSE) for i in range(10)]
    df = spark.createDataFrame(rows, "rec_id long, source_id string, batch_id long, instruction string, output string").withColumnRenamed("x", "stratum")
    gone = {r["rec_id"] for r in caps.over_cap(df, 0.03).collect()}  # 30 of 1,000 rows
    assert gone == {i for i in range(300) if i % 10}
    fewer = {r["rec_id"] for r in caps.over_cap(df, 0.015).collect()}
    kept = set(range(300)) - fewer
    assert len(kept) == 15 and all(i % 10 == 0 for i in kept) and [sum(i % 3 == s for i in kept) for s in range(3)] == [5, 5, 5]
    more = set(range(300)) - {r["rec_id"] for r in caps.over_cap(df, 0.06).collect()}
    assert len(more) == 60 and {i for i in range(300) if i % 10 == 0} <= more
    assert caps.over_cap(df.limit(0)).count() == 0


SENTENCE = "The warden of the old gate counted coins for seven winters, and nobody in the town believed that he would stop."


def test_density_finds_furniture_that_no_list_names():
    page = "\n".join(
        ["Quux", "Frobnicate", "Zaps", "Alpha | Beta | Gamma", "Sunken gate", "", SENTENCE, "History", SENTENCE, "Advertisement", SENTENCE, "", "Uno · Due · Tre", "Brewed with Frob"]
    )
    assert pages.furniture_lines(page) == [1, 2, 3, 4, 10, 13, 14]
    assert pages.furniture_lines(page, listed=False) == [1, 2, 3, 4, 13, 14]


def test_lists_and_tables_at_the_end_of_a_body_stay():
    page = "\n".join(["Home | Help | Forum", SENTENCE, SENTENCE, "* a rope", "* two torches", "Copyright 2020 Sunken gate"])
    assert pages.furniture_lines(page) == [1, 6]


@pytest.mark.parametrize("page", ["", "one line", "\n\n", "\n".join(["word"] * 30), SENTENCE + "\n" + SENTENCE, "Home\nHelp"])
def test_texts_that_are_no_pages_have_no_furniture(page):
    assert pages.furniture_lines(page) == []


def test_body_of_html_by_its_nodes():
    menu = "".join(f"<li><a href=x>Link {k}</a></li>" for k in range(12))
    page = f"<html><body><div><ul>{menu}</ul></div><div><h2>History</h2><p>{SENTENCE} <b>So</b> it <a>goes</a>.</p><p>{SENTENCE}</p><p>{SENTENCE}</p></div><div><a>Imprint</a> <a>Privacy</a></div><script>var x = 1;</script></body></html>"
    assert pages.dom_body(page) == "\n".join(["History", SENTENCE + " So it goes.", SENTENCE, SENTENCE])
    assert pages.dom_body("") == "" and pages.dom_body("<div>" * 5000) == ""


@pytest.mark.parametrize(
    "text",
    ["Let the pilgrim of [name of villain] speak.", "The chronicle of (insert description here) tells.", "He walked to XX_NAME_XX and back.", "La casa de [su texto aquí] cayó.", "[NAMEN EINFÜGEN] sah den Turm.", "Every winter undefined painted the mill."],
)
def test_more_slots(text):
    assert residue.kind(text) == "slot"


@pytest.mark.parametrize("text", ["An undefined shape stood there.", "The border was left undefined.", "See [Title](page).", "THE DUCHESS _SAW KRAETHESK_PUTHEK_ THERE", "(enter the hall with care)"])
def test_what_only_resembles_slots(text):
    assert residue.kind(text) is None


def test_long_messages_count_where_they_recur(spark):
    """A message of over 250 characters is one where three sources bring it, whatever its numbers; prose with such words isn't."""
    lines = ["Service temporarily unavailable.", "Please try again later.", "An unexpected error has occurred on our site.", "Request blocked, ray id {n}."]
    message = " ".join(lines * 4)
    prose = "The gate stood open and the old warden slept beside the fire while his dog watched the road. " * 5 + "Access denied, said the guard."
    rows = [(i, message.format(n=i * 977), {"source_id": f"site {i}"}) for i in range(3)]
    rows += [(10 + i, prose, {"source_id": f"site {i}"}) for i in range(4)] + [(20, message.replace("our", "their").format(n=5), {"source_id": "one"})]
    df = spark.createDataFrame(rows, "rec_id long, output string, metadata struct<source_id string>")
    assert {tuple(r) for r in residue.residue(df).collect()} == {(i, "error") for i in range(3)}
