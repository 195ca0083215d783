import re

from hypothesis import given, settings
from hypothesis import strategies as st

from inkmill.operators.chunk import pack, packed_chars, sound_chunks, unlike


def model(text, most, least):
    """A second, plain reading of the rules, with a buffer per paragraph kind."""
    text = re.sub("\n{3,}", "\n\n", text.replace("\r\n", "\n")).strip()
    out, buf = [], []
    size = 0

    def flush(sep):
        nonlocal buf, size
        if buf:
            out.append(sep.join(buf))
        buf, size = [], 0

    for p in (x.strip() for x in text.split("\n\n")):
        if not p:
            continue
        n = len(p.split())
        if n > most:
            flush("\n\n")
            for s in re.split(r"(?<=[.!?。！？])\s+", p):
                k = len(s.split())
                if buf and size + k > most:
                    flush(" ")
                buf.append(s)
                size += k
            flush(" ")
        else:
            if buf and size + n > most:
                flush("\n\n")
            buf.append(p)
            size += n
    flush("\n\n")
    return [x for x in out if len(x.split()) >= least]


TEXTS = st.lists(st.sampled_from(["a", "bb.", "ccc!", "d?", "\n\n", "\n", "\r\n\r\n", "\n\n\n\n", "。", "e。"]), max_size=60).map(" ".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 9), st.integers(1, 3))
def test_pack_as_model(text, most, least):
    got = pack(text, most, least)
    assert [c for c, _ in got] == model(text, most, least)
    assert all(len(c.split()) == n for c, n in got)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_pack_keeps_every_word(text, most):
    assert " ".join(c for c, _ in pack(text, most, 0)).split() == text.split()


def test_pack_of_nothing():
    assert pack(None, 5, 1) == pack("", 5, 1) == pack(" \n\n ", 5, 1) == []


def test_packed_chars(one):
    assert one(lambda x: packed_chars(x, 10), "One two. Three. A sentence that is long. x") == ["One two.", "Three.", "A sentence that is long.", "x"]
    assert one(packed_chars, None) == [] == one(packed_chars, "  ")


def test_unlike_is_greedy():
    words = [f"w{i}" for i in range(20)]
    a, b, c = words[:20], words[:19] + ["x"], words[:17] + ["x", "y", "z"]
    rows = [(" ".join(x), len(x)) for x in (a, a, b, c)] + [("", 0), ("", 0)]
    assert [t for t, _ in unlike(rows)] == [" ".join(a), " ".join(c), "", ""]


def test_sound_chunks_of_odd_tables(spark):
    schema = "text string, language string, pos2 int, packed2 string"
    empty = spark.createDataFrame([], schema)
    assert sound_chunks(empty, 350).count() == 0
    odd = spark.createDataFrame([(None, None, 1, "x"), ("", "en", 2, "y"), ("word " * 50_000, "en", 3, "z")], schema)
    got = sound_chunks(odd, 350).collect()
    assert {r["pos2"] for r in got} == {3} and len(got) == 1  # one endless sentence stays whole
