"""Pairs of texts that ``difflib`` finds alike, without comparing most of them and without losing any.

The ratio of texts a and b is 2 M / (len(a) + len(b)), M being the characters in K matching blocks. Bounds on M rule pairs out:

* Of a block of n characters, n - 1 bigrams are in both texts, so that M - K bigrams are, counted as often as they occur.
* Between two blocks lies a character that isn't matched, so that K - 1 is at most len(a) + len(b) - 2 M.
* In a b of 200 characters or more, ``difflib`` takes characters out that make up over a hundredth of it: but for one that begins
  both texts, each block then holds a character that is left, so that K - 1 is at most the number of these in b.
* M is at most the length of the longest common subsequence.

Common bigrams are counted for all pairs at once by a product of matrices. What is left is compared by ``difflib`` itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np

#: Columns of the matrices. The bigrams that a sample of the texts has most often have one each; the others share the last eighth,
#: which can only raise the number of those in common. Rows of a tile; pairs whose subsequences are measured at once.
WIDTH, SAMPLE, TILE, AT_ONCE = 1024, 512, 1024, 4096
#: The subsequences of longer texts aren't measured: their bits would take more time than ``difflib``.
LONGEST = 1024
#: From so many characters on ``difflib`` takes frequent ones out.
LONG = 200
_CODE = np.uint64(21)  # bits of a code point


def _runs(owner: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted owners and values (of ``bits`` bits), and where each run of equal ones begins."""
    keys = np.sort((owner.astype(np.uint64) << np.uint64(bits)) | value)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return (keys >> np.uint64(bits)).astype(np.int64), keys & np.uint64((1 << bits) - 1), first


class Texts:
    """Texts by their characters: lengths, bigrams by their occurrence in the text, and how many characters ``difflib`` leaves in."""

    def __init__(self, texts: Sequence[str]):
        self.texts = texts
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.append(0, np.cumsum(self.length))
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(texts)), self.length)
        same = owner[1:] == owner[:-1]
        self.owner, grams, first = _runs(owner[1:][same], ((self.codes[:-1] << _CODE) | self.codes[1:])[same], 42)
        nth = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
        self.grams = (grams << np.uint64(22)) | np.minimum(nth, (1 << 22) - 1).astype(np.uint64)
        who, _, first = _runs(owner, self.codes, 21)
        n, who = np.diff(np.append(first, len(who))), who[first]
        kept = np.bincount(who, np.where(n <= self.length[who] // 100 + 1, n, 0), len(texts))
        self.left_in = np.where(self.length < LONG, np.inf, kept).astype(np.float32)

    def matrix(self, own: np.ndarray) -> np.ndarray:
        """Bigrams by column: those of ``own`` (ascending) first, the others by hash."""
        at = np.minimum(np.searchsorted(own, self.grams), len(own) - 1)
        rest = (self.grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        column = np.where(own[at] == self.grams, at, len(own) + (rest % np.uint64(WIDTH - len(own))).astype(np.int64))
        return np.bincount(self.owner * WIDTH + column, minlength=len(self.texts) * WIDTH).reshape(-1, WIDTH).astype(np.float32)


def _most_frequent(texts: Texts) -> np.ndarray:
    grams, n = np.unique(texts.grams[texts.owner < SAMPLE], return_counts=True)
    return np.sort(grams[np.argsort(-n, kind="stable")[: WIDTH * 7 // 8]]) if len(grams) else np.zeros(1, np.uint64)


def common_subsequences(left: Texts, i: np.ndarray, right: Texts, j: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of each pair of texts, by bits that stand for the characters of the right ones."""
    alphabet, out = np.unique(right.codes), np.zeros(len(i), np.int64)
    order = np.argsort(right.length[j], kind="stable")
    for at in range(0, len(order), AT_ONCE):
        part = order[at : at + AT_ONCE]
        a, (b, back) = i[part], np.unique(j[part], return_inverse=True)
        words = max(1, -(-int(right.length[b].max()) // 64))
        masks = np.zeros((words, len(b), len(alphabet) + 1), np.uint64)  # the last symbol is that of no text
        for k, t in enumerate(b):
            own, place = np.searchsorted(alphabet, right.codes[right.start[t] : right.start[t + 1]]), np.arange(right.length[t])
            np.bitwise_or.at(masks, (place // 64, k, own), np.uint64(1) << (place % 64).astype(np.uint64))
        free = np.full((words, len(part)), ~np.uint64(0))
        n = left.length[a]
        for p in range(int(n.max())):
            code = left.codes[np.minimum(left.start[a] + p, len(left.codes) - 1)]
            symbol = np.minimum(np.searchsorted(alphabet, code), len(alphabet) - 1)
            symbol = np.where((p < n) & (alphabet[symbol] == code), symbol, len(alphabet))
            carry = np.zeros(len(part), np.uint64)
            for w in range(words):
                v = free[w]
                u = v & masks[w][back, symbol]
                s = v + u
                over = s < v
                s += carry
                carry = (over | (s < carry)).astype(np.uint64)
                free[w] = s | (v & ~u)
        out[part] = (64 - np.bitwise_count(free).astype(np.int64)).sum(axis=0)
    return out


def candidates(left: Texts, right: Texts, threshold: float, itself: bool = False):
    """Arrays of pairs, tile by tile, that the bounds don't rule out; with ``itself`` each pair of the one set once."""
    own = _most_frequent(left)
    a, b = left.matrix(own), None
    b = a if itself else right.matrix(own)
    half, rest = threshold / 2, 1 - threshold
    for at in range(0, len(a), TILE):
        rows, first = slice(at, at + TILE), at if itself else 0
        m, r = left.length[rows].astype(np.float32), right.length[first:].astype(np.float32)
        blocks = np.minimum(np.add.outer(m * np.float32(rest), r * np.float32(rest)), np.maximum.outer(left.left_in[rows], right.left_in[first:]))
        need = np.add.outer(m * np.float32(half), r * np.float32(half))
        # Single precision: sums of millions are off by less than what is allowed here.
        kept = a[rows] @ b[first:].T + blocks + np.float32(1.05) >= need * np.float32(1 - 1e-5)
        i, j = np.nonzero(np.triu(kept, 1) if itself else kept)
        i, j = i + at, j + first
        least = half * (left.length[i] + right.length[j]) - 1e-6
        near = np.minimum(left.length[i], right.length[j]) >= least
        i, j, least = i[near], j[near], least[near]
        short = (left.length[i] <= LONGEST) & (right.length[j] <= LONGEST)
        long = np.ones(len(i), bool)
        if short.any():
            long[short] = common_subsequences(left, i[short], right, j[short]) >= least[short]
        yield i[long], j[long]


def alike(ids: Sequence[str], texts: Sequence[str], others: tuple[Sequence[str], Sequence[str]] | None, threshold: float) -> list[tuple[str, str, float]]:
    """The pairs of ids, the lesser one first, and the ratios of their texts that reach ``threshold``: of all texts with one another,
    or with ``others``."""
    left = Texts(texts)
    right, names = (Texts(others[1]), others[0]) if others else (left, ids)
    out = []
    for i, j in candidates(left, right, threshold, itself=others is None):
        for m, n in zip(i.tolist(), j.tolist(), strict=True):
            if ids[m] != names[n]:
                (a, x), (b, y) = sorted(((ids[m], texts[m]), (names[n], right.texts[n])))
                if (ratio := SequenceMatcher(None, x, y).ratio()) >= threshold:
                    out.append((a, b, ratio))
    return out
