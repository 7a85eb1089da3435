"""Vectorised words of texts.

The *words* of a text are its NFKD form without combining marks, in lower case, cut at every run of
characters other than a-z and 0-9. A whole Arrow batch is turned into one code point array; word
boundaries, hashes and per-text distinct sets are found with numpy, without a loop over words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np

#: Characters handled at once; bounds a Python worker's memory whatever the length of the batch.
SLICE_CHARS = 1 << 20
#: Bits of a word's hash; the other 20 hold the text's number within its slice while words are sorted.
HASH_BITS = 44
_DROP = 255
_POSITIONS = 32


def _char_table() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x300, 0x110000):
        if code < 0xD800 or code > 0xDFFF:
            if unicodedata.combining(chr(code)):
                table[code] = _DROP
    for code in range(ord("a"), ord("z") + 1):
        table[code] = code
        table[code - 32] = code
    table[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return table


_TABLE: np.ndarray | None = None
_KEYS: np.ndarray | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    global _TABLE, _KEYS
    if _TABLE is None:
        _TABLE = _char_table()
        _KEYS = np.random.Generator(np.random.PCG64(20240607)).integers(
            0, 2**64, size=_POSITIONS * 256, dtype=np.uint64, endpoint=False
        )
    return _TABLE, _KEYS


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def slices(texts: Sequence[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` characters; a longer text stands alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if (size and size + n > limit) or i - begin >= 1 << 19:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash (``HASH_BITS`` bits) of every word, in order; null texts have no words."""
    return words_in_order(texts)[:2]


def words_in_order(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`word_hashes`, and whether each word begins with a digit, and whether a full stop, question or
    exclamation mark follows it at once."""
    table, keys = _tables()
    plain = [("" if t is None else t if t.isascii() else unicodedata.normalize("NFKD", t)) for t in texts]
    lengths = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
    if not lengths.sum():
        return none
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = table[codes]
    owner = np.repeat(np.arange(len(plain), dtype=np.int32), lengths)
    if (drop := kind == _DROP).any():
        kind, owner, codes = kind[~drop], owner[~drop], codes[~drop]
    at = np.flatnonzero(kind).astype(np.int32)
    if not len(at):
        return none
    kind, owner = kind[at], owner[at]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (at[1:] - at[:-1] != 1) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first).astype(np.int32)
    sizes = np.diff(starts, append=np.int32(len(at)))
    place = np.arange(len(at), dtype=np.int32) - np.repeat(starts, sizes)
    value = keys[((place & (_POSITIONS - 1)) << 8) | kind]
    if sizes.max() > _POSITIONS:
        value = value * (2 * (place // _POSITIONS).astype(np.uint64) + np.uint64(1))
    hashes = mix(np.add.reduceat(value, starts) + sizes.astype(np.uint64)) >> np.uint64(64 - HASH_BITS)
    after = codes[np.minimum(at[starts + sizes - 1] + 1, len(codes) - 1)]
    stop = (after == ord(".")) | (after == ord("!")) | (after == ord("?"))
    return owner[starts].astype(np.int64), hashes, kind[starts] < ord("a"), stop


def word_sets(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (one more than texts) into one array of hashes: the distinct words of each text, ascending."""
    owner, hashes = word_hashes(texts)
    both = np.sort((owner.astype(np.uint64) << np.uint64(HASH_BITS)) | hashes)
    if len(both):
        both = both[np.append(True, both[1:] != both[:-1])]
    owner, hashes = (both >> np.uint64(HASH_BITS)).astype(np.int64), both & np.uint64((1 << HASH_BITS) - 1)
    return np.searchsorted(owner, np.arange(len(texts) + 1)), hashes


def set_keys(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set (0 for an empty one); equal sets have equal keys."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    size = np.diff(bounds).astype(np.uint64)
    key = mix(total[bounds[1:]] - total[bounds[:-1]] + size * np.uint64(0x2545F4914F6CDD1D))
    key[size == 0] = 0
    return key
