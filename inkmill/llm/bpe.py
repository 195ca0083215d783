"""Byte-pair encoding with a published vocabulary, done two ways.

``Bpe.encode`` speculates and verifies: a greedy longest match proposes the tokens of each word, and the proposal stands if
every two neighbouring tokens, merged on their own, come out as those same two tokens. (A sequence of tokens is the encoding
of its bytes exactly if each neighbouring pair is.) Only words with a failing pair are merged step by step.

``Bpe.count`` walks words in sorted order and carries, for each prefix of the current word, the last token of that prefix's
encoding and the number of its tokens. A word that shares a prefix with its predecessor takes over those states: this is a
depth-first walk of the prefix trie of the words.
"""

from __future__ import annotations

import base64
import heapq
from collections import OrderedDict
from collections.abc import Iterable

import numpy as np
import regex

#: Word boundaries of the byte-level vocabularies, with Unicode's White_Space spelt out, as \s differs between regex engines.
PATTERN = regex.compile(
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_SHIFT = 20  # bits of a token id


class Bpe:
    """A vocabulary file (``.tiktoken``: base64 token and rank per line) and its caches, one per worker and file."""

    _loaded: dict[str, Bpe] = {}

    def __init__(self, ranks: dict[bytes, int], kept: int = 200_000):
        self.ranks, self.kept = ranks, kept
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: Lengths of the tokens by their first two and their last two bytes, longest first: what a match has to try.
        heads: dict[bytes, set[int]] = {}
        tails: dict[bytes, set[int]] = {}
        for b in ranks:
            if len(b) > 1:
                heads.setdefault(b[:2], set()).add(len(b))
                tails.setdefault(b[-2:], set()).add(len(b))
        self.heads = {k: sorted(v, reverse=True) for k, v in heads.items()}
        self.tails = {k: sorted(v, reverse=True) for k, v in tails.items()}
        self._fit: dict[int, bool] = {}
        self._known = np.empty(0, np.int64)
        self._known_fit = np.empty(0, bool)
        self._words: OrderedDict[str, tuple[int, ...]] = OrderedDict()
        self._counts: OrderedDict[str, int] = OrderedDict()

    @classmethod
    def load(cls, path: str) -> Bpe:
        if path not in cls._loaded:
            with open(path, "rb") as f:
                cls._loaded[path] = cls({base64.b64decode(t): int(r) for t, r in (x.split() for x in f if x.strip())})
        return cls._loaded[path]

    # -- exact merging -------------------------------------------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Merges by rank, lowest first, leftmost first among equals; O(n log n) by a heap over a linked list."""
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        n = len(word)
        part: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            a = part[i]
            if a is None or (j := after[i]) >= n or len(a) + len(part[j]) != size:
                continue
            both = a + part[j]
            part[i], part[j] = both, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                x = both + part[k]
                if (r := ranks.get(x)) is not None:
                    heapq.heappush(heap, (r, i, len(x)))
            if (h := before[i]) >= 0:
                x = part[h] + both
                if (r := ranks.get(x)) is not None:
                    heapq.heappush(heap, (r, h, len(x)))
        return [ranks[x] for x in part if x is not None]

    def fits(self, a: int, b: int) -> bool:
        """Whether the tokens a and b, written together, encode to just these two."""
        key = a << _SHIFT | b
        if (known := self._fit.get(key)) is None:
            if len(self._fit) > 4_000_000:
                self._fit.clear()
            known = self._fit[key] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    # -- speculate and verify ------------------------------------------------------------------------------------------

    def propose(self, word: bytes) -> list[int]:
        ranks, heads = self.ranks, self.heads
        if (whole := ranks.get(word)) is not None:
            return [whole]
        found, i, n = [], 0, len(word)
        while i < n:
            for size in heads.get(word[i : i + 2], ()):
                if i + size <= n and (t := ranks.get(word[i : i + size])) is not None:
                    break
            else:
                size, t = 1, ranks[word[i : i + 1]]
            found.append(t)
            i += size
        return found

    def _verify(self, proposals: list[list[int]]) -> np.ndarray:
        """For each proposal, whether all its neighbouring pairs fit; one vectorised look-up for all of them."""
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(proposals)), sizes)
        inside = owner[1:] == owner[:-1]
        keys = (flat[:-1] << _SHIFT | flat[1:])[inside]
        distinct, where = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self._known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self._known):
            new = self._known[np.minimum(at, len(self._known) - 1)] != distinct
        fit = np.empty(len(distinct), bool)
        if len(self._known):
            fit[~new] = self._known_fit[at[~new]]
        for k in np.flatnonzero(new):
            key = int(distinct[k])
            fit[k] = self.merge(self.tokens[key >> _SHIFT] + self.tokens[key & (1 << _SHIFT) - 1]) == [key >> _SHIFT, key & (1 << _SHIFT) - 1]
        if new.any():
            if len(self._known) > 2_000_000:
                self._known, self._known_fit = np.empty(0, np.int64), np.empty(0, bool)
                merged, fits = distinct, fit
            else:
                merged = np.concatenate([self._known, distinct[new]])
                fits = np.concatenate([self._known_fit, fit[new]])
            order = np.argsort(merged, kind="stable")
            self._known, self._known_fit = merged[order], fits[order]
        good = np.ones(len(proposals), bool)
        good[owner[1:][inside][~fit[where]]] = False
        return good

    def encode(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Token ids of each text; none for an empty or null one. Special-token strings are ordinary text."""
        split = [PATTERN.findall(_clean(t)) if t else [] for t in texts]
        cache = self._words
        fresh = list({w for ws in split for w in ws} - cache.keys())
        if len(cache) + len(fresh) > self.kept + len(fresh):
            cache.clear()
            fresh = list({w for ws in split for w in ws})
        coded = [w.encode() for w in fresh]
        proposals = [self.propose(b) for b in coded]
        if proposals:
            for word, b, p, good in zip(fresh, coded, proposals, self._verify(proposals).tolist()):
                cache[word] = p if good else self.merge(b)
        out = []
        for ws in split:
            ids: list[int] = []
            for w in ws:
                ids += cache[w]
            out.append(ids)
        return out

    # -- counting along a prefix trie ----------------------------------------------------------------------------------

    def count_words(self, pieces: list[bytes]) -> list[int]:
        """Numbers of tokens of distinct pieces given in sorted order."""
        ranks, tails, fits = self.ranks, self.tails, self.fits
        before, last, count, out = b"", [0], [0], []
        for piece in pieces:
            n, m = len(piece), min(len(before), len(piece))
            shared = m if before[:m] == piece[:m] else next(i for i in range(m) if before[i] != piece[i])
            del last[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for size in (*tails.get(piece[end - 2 : end], ()), 1) if end > 1 else (1,):
                    if size > end or (t := ranks.get(piece[end - size : end])) is None:
                        continue
                    if size == end or fits(last[end - size], t):
                        last.append(t)
                        count.append(count[end - size] + 1)
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            out.append(count[n])
            before = piece
        return out

    def count(self, texts: Iterable[str | None]) -> list[int]:
        """The number of tokens of each text, without encoding it; 0 for an empty or null one."""
        split = [PATTERN.findall(_clean(t)) if t else [] for t in texts]
        cache = self._counts
        fresh = list({w for ws in split for w in ws} - cache.keys())
        if len(cache) > self.kept:
            cache.clear()
            fresh = list({w for ws in split for w in ws})
        coded = sorted((w.encode(), w) for w in fresh)
        cache.update(zip((w for _, w in coded), self.count_words([b for b, _ in coded])))
        return [sum(map(cache.__getitem__, ws)) for ws in split]


def _clean(text: str) -> str:
    """Lone surrogates, which UTF-8 can't write, become U+FFFD."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-8", "surrogatepass").decode("utf-8", "replace")
