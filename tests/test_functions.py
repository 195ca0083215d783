import pytest
from pyspark.sql import functions as F

from inkmill.functions import quality, text


@pytest.mark.parametrize("x", ["", "   ", "a b", "　a b\x1fc ", "one\n\ntwo\tthree", " wide "])
def test_words_as_str_split(one, x):
    assert one(text.words, x) == x.split()
    assert one(text.word_count, x) == len(x.split())
    assert one(text.strip, x) == x.strip()


@pytest.mark.parametrize("x", ["", "a", "a\n", "a\nb", "a\r\nb\x0bc d", "\n\n", "a\n\nb\n"])
def test_lines_as_splitlines(one, x):
    assert one(text.lines, x) == x.splitlines()
    filled = [y for y in x.splitlines() if y.strip()]
    share = sum(len(y.split()) == 1 for y in filled) / len(filled) if filled else 0.0
    assert one(quality.single_word_lines, x) == pytest.approx(share)


def test_null_texts(one):
    assert one(text.word_count, None) == 0
    assert one(text.words, None) is None
    assert one(lambda x: quality.reject_reason(x, F.lit("en")), None) == "short"


def test_sentences_and_even(one):
    assert one(text.sentences, " One. Two?  三。 四！x ") == ["One.", "Two?", "三。", "四！x"]
    assert one(text.even, "a\r\n\r\n\r\n\r\nb\n") == "a\n\nb"


def test_clean(one):
    assert one(text.clean, "ﬁne &amp;  good\n\n\n\n x") == "fine & good\n\nx"


def test_quality_gate(one):
    def reason(x, language="en"):
        return one(lambda c: quality.reject_reason(c, F.lit(language)), x)

    prose = "The keeper walked along the wall and counted every lantern twice. " * 8
    assert reason(prose) is None
    assert reason(" ".join(["word"] * 79)) == "short"
    assert reason(" ".join(["word"] * 80)) is None
    assert reason("\n".join(["word"] * 40) + "\n" + prose) == "list"
    assert reason("1 " * 100) == "letters"
    assert reason("ab " * 100) == "word_length"
    assert reason("слово " * 100 + "a") == "language"
    assert reason(prose, "ja") == "kana"
    assert reason(prose, "fr") is None
    assert reason(prose + "All rights reserved. Privacy policy.") == "boilerplate"
    assert reason(prose + "All rights reserved.") is None


def test_pick_depends_on_the_key_alone(spark):
    rows = spark.range(50).select(text.pick(7, "seed", F.col("id")).alias("p"))
    first, second = ([r["p"] for r in rows.collect()] for _ in range(2))
    assert first == second and set(first) <= set(range(7)) and len(set(first)) > 3
