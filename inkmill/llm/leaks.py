"""Problem 9: evaluation passages inside training documents, by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .columns import take
from .text import CJK, WORD, fold, is_cjk, squeeze

#: Fixed masks over a window of 15 words: 1 counts, 0 is ignored, so that a changed word under a 0 leaves the hash as it is.
WORD_MASKS = ("110110101101101", "111010011100111")
#: The same over 40 letters and digits, for texts in Japanese and Chinese.
CHAR_MASKS = ("1101101110110111011011101101110110111011", "1110111001110111011100111011101110011101")
WORD_RUN, CHAR_RUN = 15, 40

_hashes: dict[str, int] = {}


def _codes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash per token, the same on every worker."""
    if len(_hashes) > 500_000:
        _hashes.clear()
    get, put, h = _hashes.get, _hashes.__setitem__, xxhash.xxh3_64_intdigest
    out = []
    for t in tokens:
        if (x := get(t)) is None:
            put(t, x := h(t))
        out.append(x)
    return np.array(out, np.uint64)


def _weights(mask: str) -> list[tuple[int, np.uint64]]:
    return [(i, np.uint64(xxhash.xxh3_64_intdigest(f"{mask}{i}") | 1)) for i, c in enumerate(mask) if c == "1"]


def _seeds(codes: np.ndarray, mask: str) -> np.ndarray:
    """The masked hash of the window at each position."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, w in _weights(mask):
        x = codes[i : i + n] * w
        total += x ^ (x >> np.uint64(29))
    return total


def _streams(text: str, eval_side: bool) -> list[tuple[str, list[str]]]:
    """The token streams a text is compared in: words, and single characters if any of it is Japanese or Chinese."""
    if eval_side:
        return [("c", list(squeeze(text)))] if is_cjk(text) else [("w", WORD.findall(fold(text)))]
    out = [("w", WORD.findall(fold(text)))]
    if not text.isascii() and CJK.search(text):
        out.append(("c", list(squeeze(text))))
    return out


class Index:
    """The seeds of a block of evaluation items: sorted hashes with their item and position."""

    def __init__(self, items: list[tuple[int, str]]):
        self.codes: dict[str, list[np.ndarray]] = {"w": [], "c": []}
        self.ids: dict[str, list[int]] = {"w": [], "c": []}
        for item, text in items:
            for kind, tokens in _streams(text, True):
                self.ids[kind].append(item)
                self.codes[kind].append(_codes(tokens))
        self.seeds: dict[tuple[str, str], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for kind, masks in (("w", WORD_MASKS), ("c", CHAR_MASKS)):
            for mask in masks:
                each = [_seeds(c, mask) for c in self.codes[kind]]
                value = np.concatenate([*each, np.empty(0, np.uint64)])
                owner = np.repeat(np.arange(len(each)), [len(e) for e in each]) if each else np.empty(0, int)
                place = np.concatenate([*(np.arange(len(e)) for e in each), np.empty(0, int)]).astype(int)
                order = np.argsort(value, kind="stable")
                self.seeds[kind, mask] = value[order], owner[order], place[order]

        self._by_char = set(self.ids["c"])

    def by_char(self, item: int) -> bool:
        return item in self._by_char

    def find(self, text: str) -> list[tuple[int, int, float]]:
        """(item, longest exact run, share of the item's tokens matched along its best alignment) of each item hit."""
        best: dict[int, tuple[int, float]] = {}
        for kind, tokens in _streams(text, False):
            run = WORD_RUN if kind == "w" else CHAR_RUN
            if len(tokens) < run or not self.ids[kind]:
                continue
            codes = _codes(tokens)
            lines: set[tuple[int, int]] = set()
            for mask in WORD_MASKS if kind == "w" else CHAR_MASKS:
                value, owner, place = self.seeds[kind, mask]
                if not len(value):
                    continue
                seeds = _seeds(codes, mask)
                left = np.searchsorted(value, seeds)
                hit = np.flatnonzero(value[np.minimum(left, len(value) - 1)] == seeds)
                for i in hit.tolist():
                    k, s = int(left[i]), seeds[i]
                    while k < len(value) and value[k] == s:
                        lines.add((int(owner[k]), i - int(place[k])))
                        k += 1
            for o, shift in lines:  # an alignment: document position = item position + shift
                item = self.codes[kind][o]
                a, b = max(0, -shift), min(len(item), len(codes) - shift)
                same = item[a:b] == codes[a + shift : b + shift]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
                longest = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
                share = float(same.sum()) / max(1, len(item))
                old = best.get(self.ids[kind][o], (0, 0.0))
                best[self.ids[kind][o]] = max(old[0], longest), max(old[1], share)
        return [(i, n, s) for i, (n, s) in best.items()]


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_chars: int = 8_000_000,
) -> DataFrame:
    """(key, item_key, run, unit, share): all documents and items that meet in a spaced-seed hit, verified around the hit.

    ``run`` is the longest exact run of words (``unit`` "w") or of letters and digits ("c", items in Japanese or Chinese),
    ``share`` the part of the item's tokens that agree along the best alignment, substitutions tolerated. A window that agrees
    wholly is always hit, so no run of 15 words or 40 characters is missed. Case, punctuation and white space don't count.

    Items are the query side. They are cut into blocks of at most ``block_chars`` characters, and each block's index, which is
    thereby bounded, is shipped to one pass over the documents; documents are never shuffled, and the driver holds one block at a time. Null or empty texts match
    nothing; repeated documents give repeated rows, repeated items one row each; null keys are kept on the document side and
    dropped on the item side.
    """
    blocks = (
        take(items, item=F.col(item_key).cast("long"), text=item_text)
        .where("item is not null and text is not null and text <> ''")
        .distinct()
    )
    sizes = blocks.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    count = max(1, -(-int(sizes) * 2 // block_chars)) if sizes > block_chars else 1
    wanted = take(docs, **{key: key, "text": text})
    kind = dict(wanted.dtypes)[key]
    parts = []
    for b in range(count):
        block = blocks if count == 1 else blocks.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == b)
        held = [(r["item"], r["text"]) for r in block.toLocalIterator()]

        def scan(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            index = Index(held)
            for batch in batches:
                rows = [
                    (k, item, n, "c" if index.by_char(item) else "w", share)
                    for k, t in zip(batch[key], batch["text"])
                    if isinstance(t, str) and t
                    for item, n, share in index.find(t)
                ]
                yield pd.DataFrame(rows, columns=[key, item_key, "run", "unit", "share"])

        found = wanted.mapInPandas(scan, f"`{key}` {kind}, `{item_key}` long, run long, unit string, share double")
        # of several blocks each one's hits are written before the next block is fetched, so that the driver holds one at a time
        parts.append(found if count == 1 else stored(found, "overlaps"))
    return reduce(DataFrame.unionByName, parts)


def leaked(found: DataFrame) -> DataFrame:
    """The rows of ``overlaps`` that hold an exact run of at least 15 words, or of 40 letters and digits."""
    return found.where(F.col("run") >= F.when(F.col("unit") == "c", CHAR_RUN).otherwise(WORD_RUN))
