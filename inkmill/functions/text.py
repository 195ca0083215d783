"""Text columns: whitespace, words, sentences, hashes and picks, all within the JVM; ``clean`` alone needs Python."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import WS


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{WS}+|{WS}+\\z", "")


def words(x: Column) -> Column:
    """The parts between white space; empty for a blank text, null for null."""
    bare = strip(x)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{WS}+"))


def word_count(x: Column) -> Column:
    """The number of ``words``, counted without making them; 0 for null. ASCII texts need to know two ranges of blanks only."""
    x = F.coalesce(x, F.lit(""))
    ascii_only = F.octet_length(x) == F.length(x)
    count = F.when(ascii_only, F.regexp_count(x, F.lit("[^\\t-\\r\\x1c- ]+"))).otherwise(F.regexp_count(x, F.lit(f"[^{WS[1:-1]}]+")))
    return count.cast("long")


def lines(x: Column) -> Column:
    """As str.splitlines: a final line end makes no further line."""
    ends = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
    bare = F.regexp_replace(x, f"(?:{ends})\\z", "")
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(bare, ends))


def even(x: Column) -> Column:
    """Line ends as \\n, at most one blank line between paragraphs, nothing around."""
    return strip(F.regexp_replace(F.replace(x, F.lit("\r\n"), F.lit("\n")), "\\n{3,}", "\n\n"))


def sentences(x: Column, marks: str = ".!?。！？") -> Column:
    """The sentences of a text, parted at white space behind a mark."""
    return F.split(strip(x), f"(?<=[{marks}]){WS}+")


def md5_of(x: Column, prefix: str = "") -> Column:
    return F.md5(F.concat(F.lit(prefix), strip(x)))


def token_estimate(x: Column) -> Column:
    return F.floor(F.length(x) / F.lit(3.5)).cast("long")


def pick(choices: int, *key: Column | str) -> Column:
    """A number below ``choices`` that depends on the key alone, the same in any engine with md5."""
    text = F.concat_ws("|", *[F.lit(k) if isinstance(k, str) else k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % choices


def roll(*key: Column | str) -> Column:
    """A number from 0 to 1 that depends on the key alone."""
    text = F.concat_ws("|", *[F.lit(k) if isinstance(k, str) else k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def lookup(x: Column, table: dict[str, str]) -> Column:
    """The value of a fixed map, or the key itself."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), x), x)


def literal_of(pattern: str) -> str:
    """The longest run of plain letters and blanks that every match of a pattern holds."""
    flat = re.sub(r"\([^()]*\)", "\0", pattern)
    runs = re.findall(r"(?:\\b)?([a-z<:][a-z :]*)([?*{]?)", re.sub(r"\\[^b]", "\0", flat))
    return max((r[:-1] if q else r for r, q in runs), key=len)


def matches(x: Column, patterns: list[str]) -> Column:
    """How many of the patterns a text holds, whatever the case; a regex runs only where its literal part occurs."""
    low = F.lower(x)
    total = F.lit(0)
    for p in patterns:
        total = total + (F.contains(low, F.lit(literal_of(p))) & x.rlike(f"(?iUd){p}")).cast("int")
    return total


@F.pandas_udf(T.StringType())
def clean(texts: pd.Series) -> pd.Series:
    """Entities resolved, NFKC, blanks within lines evened out, blank lines reduced to one."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        text = unicodedata.normalize("NFKC", html.unescape(text))
        rows = [re.sub(r"[ \t]+", " ", x).strip() for x in text.splitlines()]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(rows)).strip()

    return texts.map(one, na_action="ignore")
