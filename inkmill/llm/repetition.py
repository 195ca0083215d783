"""Problem 10: repetition inside a document, by an exact share, with an isolation forest over rule statistics beside it."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import take
from .text import is_cjk, words

#: More than this share of a document's words (or characters) must have been given before.
LIMIT = 0.45
#: Length of the runs that are looked up, and of a gap between two repeated runs that counts as a swapped name.
WORD_RUN, WORD_GAP = 4, 2
CHAR_RUN, CHAR_GAP = 12, 5
#: Rows the forest is fitted on, at most; trees and rows per tree.
SAMPLE, TREES, PER_TREE = 4096, 64, 256
_SENTENCE = re.compile(r"[.!?。！？\n]+")


def _content(text: str) -> list[str]:
    return [w for w in words(text) if not w.isdigit()]


def share(text: str) -> float:
    """The share of tokens inside runs that this document has given before; numbers don't count, short gaps are filled."""
    tokens = _content(text)
    run, gap = (CHAR_RUN, CHAR_GAP) if is_cjk(text) else (WORD_RUN, WORD_GAP)
    n = len(tokens)
    if n <= run:
        return 0.0
    seen: set[tuple[str, ...]] = set()
    covered = bytearray(n)
    for i in range(n - run + 1):
        piece = tuple(tokens[i : i + run])
        if piece in seen:
            covered[i : i + run] = b"\1" * run
        else:
            seen.add(piece)
    total, last = 0, -1
    for i in np.flatnonzero(np.frombuffer(covered, np.uint8)).tolist():
        total += 1 + (i - last - 1 if last >= 0 and i - last - 1 <= gap else 0)
        last = i
    return total / n


def statistics(text: str) -> list[float]:
    """Rule statistics of a text, each larger the more it repeats itself (but for the last, its length)."""
    tokens = _content(text)
    n = len(tokens)
    if n < 2:
        return [0.0] * 6 + [0.0]
    raw = text.encode("utf-8", "replace")
    sentences = Counter(s for s in (" ".join(_content(x)) for x in _SENTENCE.split(text)) if s)
    lengths = sum(len(s) * c for s, c in sentences.items())
    again = sum(len(s) * (c - 1) for s, c in sentences.items())
    pairs = list(zip(tokens, tokens[1:]))
    threes = list(zip(tokens, tokens[1:], tokens[2:]))
    return [
        1 - min(1.0, len(zlib.compress(raw, 1)) / len(raw)),
        1 - len(set(tokens)) / n,
        1 - len(set(pairs)) / len(pairs),
        1 - len(set(threes)) / len(threes) if threes else 0.0,
        again / lengths if lengths else 0.0,
        max(Counter(tokens).values()) / n,
        math.log1p(n),
    ]


class Forest:
    """Isolation trees as arrays: at each node a statistic and a cut, or the path length where a branch ends."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7):
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rng = np.random.default_rng(seed)
        for _ in range(trees if len(rows) else 0):
            part = rows[rng.permutation(len(rows))[:per_tree]]
            self.trees.append(self._grow(part, rng, max(1, math.ceil(math.log2(max(2, len(part)))))))

    @staticmethod
    def _rest(n: int) -> float:
        """The mean path length of an unsuccessful search among n rows."""
        return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, rows: np.ndarray, rng: np.random.Generator, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = 2 ** (height + 1)
        feature, cut, ends = np.full(size, -1), np.zeros(size), np.zeros(size)
        todo = [(1, rows, 0)]
        while todo:
            node, part, depth = todo.pop()
            spread = np.flatnonzero(part.max(0) > part.min(0)) if len(part) > 1 and depth < height else []
            if len(spread) == 0:
                ends[node] = depth + self._rest(len(part))
                continue
            f = int(rng.choice(spread))
            c = rng.uniform(part[:, f].min(), part[:, f].max())
            feature[node], cut[node] = f, c
            left = part[:, f] <= c
            todo += [(2 * node, part[left], depth + 1), (2 * node + 1, part[~left], depth + 1)]
        return feature, cut, ends

    def paths(self, rows: np.ndarray) -> np.ndarray:
        """The mean path length of each row: short for rows that few random splits set apart."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for feature, cut, ends in self.trees:
            node = np.ones(len(rows), int)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[each, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + right, node)
            total += ends[node]
        return total / max(1, len(self.trees))


def fit(docs: DataFrame, key: str, text: str, sample: int = SAMPLE) -> Forest:
    """A forest fitted on at most ``sample`` documents, those with the smallest hashes of their keys."""
    plain = take(docs, key=key, text=text).where("key is not null and text is not null")
    chosen = plain.select("key").orderBy(F.xxhash64("key"), "key").limit(sample).distinct()
    rows = plain.join(F.broadcast(chosen), "key").dropDuplicates(["key"])

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [statistics(t) for t in b["text"]]})

    got = rows.mapInPandas(describe, "x array<double>").collect()
    return Forest(np.array([r["x"] for r in got]) if got else np.empty((0, 7)))


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(key, path, share) of every document: its path length in the forest and its repeated share, exact whatever the path.

    A short path tells that a document's statistics are unlike those of most; nothing depends on it. Case,
    punctuation, numbers and white space don't count; up to two words (five characters in Japanese and Chinese) between two
    repeated runs count as a swapped name. Null and empty texts have a path of 0 and no share. One pass without a shuffle
    follows the fit on a bounded sample; ties and repeated rows have equal results.
    """
    forest = fit(docs, key, text, sample)
    rows = take(docs, **{key: key, "text": text})

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            paths = forest.paths(np.array([statistics(t) for t in texts]).reshape(-1, 7)) if texts else np.empty(0)
            shares = [share(t) if t else None for t in texts]
            yield pd.DataFrame({key: b[key], "path": [p if t else 0.0 for t, p in zip(texts, paths)], "share": pd.Series(shares, dtype=object)})

    return rows.mapInPandas(measure, f"`{key}` {dict(rows.dtypes)[key]}, path double, share double")
