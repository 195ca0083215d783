"""The quality gate of chunks as columns, each rule by itself."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import BAD_SAMPLE, BOILERPLATE, BOILERPLATE_LEAST, WS
from .text import literal_of, matches, word_count

LETTER = r"\p{L}"
LATIN = "[A-Za-z]"
KANA = "[\\u3040-\\u30ff]"
HAN = "[\\u4e00-\\u9fff]"
ENDS = "\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029"
BLANKS = "\\t\\x1f \\xa0\\u1680\\u2000-\\u200a\\u202f\\u205f\\u3000"


def single_word_lines(x: Column) -> Column:
    """The share of lines of one word among the lines that aren't blank; 0 without lines. Counted without splitting."""
    filled = F.regexp_count(x, F.lit(f"[^{ENDS}]*[^{WS[1:-1]}][^{ENDS}]*"))
    single = F.regexp_count(x, F.lit(f"(?<![^{ENDS}])[{BLANKS}]*[^{WS[1:-1]}]+[{BLANKS}]*(?![^{ENDS}])"))
    return F.when(filled > 0, single / filled).otherwise(F.lit(0.0))


def mean_word_length(x: Column) -> Column:
    n = word_count(x)
    return F.when(n > 0, (F.length(x) - F.regexp_count(x, F.lit(WS))) / n).otherwise(F.lit(0.0))


def kana_share(x: Column) -> Column:
    return F.when(F.length(x) > 0, F.regexp_count(x, F.lit(KANA)) / F.length(x)).otherwise(F.lit(0.0))


def mismatch(x: Column, language: Column) -> Column:
    """Whether the letters belie the language: English with under 70 % ASCII, Japanese with under 30 % Han and kana letters."""
    letters = F.regexp_count(x, F.lit(LETTER))
    ascii_share = F.regexp_count(x, F.lit(LATIN)) / letters
    cjk_share = (F.regexp_count(x, F.lit(HAN)) + F.regexp_count(x, F.lit("[\\u3040-\\u30ff&&\\p{L}]"))) / letters
    return F.when(letters == 0, F.lit(False)).otherwise(
        F.when(language == "en", ascii_share < 0.70).when(language == "ja", cjk_share < 0.30).otherwise(F.lit(False))
    )


def boilerplate(x: Column) -> Column:
    return matches(x, BOILERPLATE)


def is_bad(x: Column) -> Column:
    return matches(x, BAD_SAMPLE) > 0


_KANA, _LATIN_OR_CJK = re.compile(KANA), re.compile(f"{LATIN}|{KANA}|{HAN}")
_BOILERPLATE = [(literal_of(p), re.compile(p, re.IGNORECASE)) for p in BOILERPLATE]


def gate(text: str, language: str | None, min_words: int = 80) -> str | None:
    """The first rule a chunk breaks, cheap rules first; None for a sound one.

    The rules count the same things several times over, which the JVM's regex engine does at 1 MB a second and core and
    Python's string functions at 20; so the gate as a whole runs over Arrow batches. The columns above show single rules.
    """
    parts = text.split()
    n = len(parts)
    if n < min_words:
        return "short"
    filled = [k for x in text.splitlines() if (k := len(x.split(None, 2)))]
    if filled and sum(k == 1 for k in filled) / len(filled) > 0.30:
        return "list"
    if not _LATIN_OR_CJK.search(text):
        return "letters"
    if language == "en" and not 3.0 <= sum(map(len, parts)) / n <= 12.0:
        return "word_length"
    if language == "ja" and len(_KANA.findall(text)) / len(text) < 0.10:
        return "kana"
    if language in ("en", "ja") and not (language == "en" and text.isascii()):
        letters = [c for c in text if c.isalpha()]
        if language == "en":
            if letters and sum(c.isascii() for c in letters) / len(letters) < 0.70:
                return "language"
        elif letters and sum("\u4e00" <= c <= "\u9fff" or "\u3040" <= c <= "\u30ff" for c in letters) / len(letters) < 0.30:
            return "language"
    low = text.lower()
    if sum(literal in low and pattern.search(text) is not None for literal, pattern in _BOILERPLATE) >= BOILERPLATE_LEAST:
        return "boilerplate"
    return None


def reject_reason(x: Column, language: Column, min_words: int = 80) -> Column:
    """``gate`` as a column; a null text is short."""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series, languages: pd.Series) -> pd.Series:
        return pd.Series([gate(t, v, min_words) if isinstance(t, str) else "short" for t, v in zip(texts, languages)], dtype=object)

    return run(x, language)
