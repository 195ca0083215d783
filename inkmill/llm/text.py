"""Text primitives shared by the operators of this subpackage (plain Python, run inside Arrow batches)."""

from __future__ import annotations

import json
import re
import unicodedata

import xxhash

#: Han, kana, Hangul: scripts written without spaces between words.
CJK = re.compile("[぀-ヿㇰ-ㇿ㐀-䶿一-鿿가-힯ｦ-ﾟ]")
WORD = re.compile(r"[^\W_]+")
NOT_ALNUM = re.compile(r"[\W_]+")
_CJK_OR_WORD = re.compile(
    "[぀-ヿㇰ-ㇿ㐀-䶿一-鿿가-힯ｦ-ﾟ]"
    "|[^\\W_぀-ヿㇰ-ㇿ㐀-䶿一-鿿가-힯ｦ-ﾟ]+"
)
#: For ASCII texts, of which most have nothing else: all but letters and digits become blanks.
_ASCII_BLANKS = "".join(chr(i) if chr(i).isalnum() else " " for i in range(128))
_FIELD_LINE = re.compile(r"^[\s>*#\-]*([^\W\d_][\w '’*\-]{0,40}?)[*_\s]*[:：]\s*(.*\S)\s*$")


def fold(text: str) -> str:
    """NFKC, full case folding; the shared base of every comparison "whatever the case"."""
    return unicodedata.normalize("NFKC", text).casefold() if not text.isascii() else text.lower()


def is_cjk(text: str, letters: int | None = None) -> bool:
    """True where more than a third of the letters and digits (counted here, if not given) are Han, kana or Hangul."""
    if text.isascii():
        return False
    found = len(CJK.findall(text))
    if not found:
        return False
    return 3 * found > (len(NOT_ALNUM.sub("", text)) if letters is None else letters)


def words(text: str) -> list[str]:
    """Folded words; each Han, kana or Hangul character is a token of its own."""
    folded = fold(text)
    if folded.isascii():
        return folded.translate(_ASCII_BLANKS).split()
    return (_CJK_OR_WORD if CJK.search(folded) else WORD).findall(folded)


def squeeze(text: str) -> str:
    """Folded letters and digits only."""
    folded = fold(text)
    return folded.translate(_ASCII_BLANKS).replace(" ", "") if folded.isascii() else NOT_ALNUM.sub("", folded)


def _flat(value: object) -> str:
    """A JSON value as text; object members are ordered by name, lists keep their order."""
    if isinstance(value, dict):
        return "\n".join(f"{k} {_flat(v)}" for k, v in sorted(((squeeze(str(k)), v) for k, v in value.items()), key=lambda x: x[0]))
    if isinstance(value, list):
        return " ".join(map(_flat, value))
    return str(value)


def fields_in_order(text: str) -> str:
    """``text`` with named fields put in one order: JSON objects, or blocks of "Name: value" lines.

    A text counts as a block of fields if every line is one and there are three or more with different names; anything else
    comes back unchanged.
    """
    body = text.strip().strip("﻿​")
    if body[:1] in "{[" and body[-1:] in "}]" and len(body) > 2:
        try:
            value = json.loads(body)
        except (ValueError, RecursionError):
            value = None
        if isinstance(value, (dict, list)):
            return _flat(value)
    if body.count(":") + body.count("：") >= 3:
        found = {}
        lines = [x for x in body.splitlines() if x.strip()]
        if len(lines) >= 3:
            for line in lines:
                m = _FIELD_LINE.match(line)
                if not m or (key := squeeze(m[1])) in found:
                    return text
                found[key] = m[2]
            return "\n".join(f"{k} {v}" for k, v in sorted(found.items()))
    return text


def canonical(text: str) -> str:
    """What is left of a text when white space, letter case, punctuation and field order are set aside."""
    return squeeze(fields_in_order(text))


def h64(text: str | bytes) -> int:
    """A signed 64-bit hash, the same on every worker."""
    x = xxhash.xxh3_64_intdigest(text)
    return x - (1 << 64) if x >= 1 << 63 else x


def h128(text: str | bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)
