"""Problem 7: encoding a corpus with a public byte-level BPE vocabulary.

Pre-tokens are located without a regular expression. Every code point has a class, every class is a function from
the state before it to the state after it, and the few dozen functions that arise from composing these form a table,
so the states of a whole batch come from an associative scan: each pass composes neighbouring functions by one table
lookup, and the scan ends when every function is constant, after a pass or two. The slices between boundaries go
through a cache of encoded pieces; unknown pieces are merged together, pair by pair, in numpy. Slice offsets are kept,
so ids can be taken back to the characters they stand for.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.wordsets import slices

#: Where vocabularies of public tokenizers lie unless a path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces kept by a task; beyond it the cache starts anew.
CACHE_PIECES = 300_000
_NONE = np.int32(2**31 - 1)

SEP, SPACE, WHITE, NUMBER, OTHER, QUOTE, STMD, RV, ELL, EE, LETTER = range(11)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, QUOTED, WANTS_E, WANTS_L, DONE = range(10)
#: The code points with the property White_Space but the space.
WHITES = (9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _classes() -> np.ndarray:
    table = np.full(0x110001, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[list(WHITES)] = WHITE
    table[0x20], table[0x27], table[0x110000] = SPACE, QUOTE, SEP
    for letters, kind in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", EE)):
        for x in letters:
            table[ord(x)] = kind
    return table


def _after(state: int, kind: int) -> int:
    """The automaton: the state after a code point of a class. A quote that begins a token may open a contraction."""
    if kind == SEP:
        return START
    if kind == SPACE:
        return AFTER_SPACE
    if kind == WHITE:
        return AFTER_WHITE
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == OTHER or (kind == QUOTE and state in (IN_OTHERS, QUOTED, AFTER_SPACE)):
        return IN_OTHERS
    if kind == QUOTE:
        return QUOTED
    if (state, kind) in ((QUOTED, STMD), (WANTS_E, EE), (WANTS_L, ELL)):
        return DONE
    if state == QUOTED and kind in (RV, ELL):
        return WANTS_E if kind == RV else WANTS_L
    return IN_LETTERS


def _begins(state: int, kind: int) -> bool:
    """Whether a token begins here, before looking at the next code point."""
    if kind in (SEP, SPACE, WHITE):
        return kind != SEP and state not in (AFTER_SPACE, AFTER_WHITE)
    if kind == NUMBER:
        return state not in (IN_NUMBERS, AFTER_SPACE)
    if kind in (OTHER, QUOTE):
        return state not in (IN_OTHERS, QUOTED, AFTER_SPACE)
    return state not in (IN_LETTERS, WANTS_E, WANTS_L, AFTER_SPACE) and (state, kind) != (QUOTED, STMD)


class Scanner:
    """Finds where pre-tokens begin."""

    def __init__(self) -> None:
        self.classes = _classes()
        functions = [tuple(_after(s, c) for s in range(10)) for c in range(11)]
        number = {f: i for i, f in enumerate(dict.fromkeys(functions))}
        self.of_class = np.array([number[f] for f in functions], dtype=np.uint8)
        todo = list(number)
        while todo:  # the monoid that the classes' functions generate
            f = todo.pop()
            for g in list(number):
                for h in (tuple(f[x] for x in g), tuple(g[x] for x in f)):
                    if h not in number:
                        number[h] = len(number)
                        todo.append(h)
        every = list(number)
        assert len(every) < 256
        self.size = len(every)
        self.compose = np.array([number[tuple(f[x] for x in g)] for f in every for g in every], dtype=np.uint8)
        self.constant = np.array([len(set(f)) == 1 for f in every])
        self.value = np.array([f[START] for f in every], dtype=np.uint8)
        self.begins = np.array([_begins(s, c) for s in range(10) for c in range(11)])

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Positions at which tokens begin; ``codes`` holds texts, each behind a separator (0x110000), and one at the end."""
        kind = self.classes[codes]
        done = self.of_class[kind]
        step = 1
        while not self.constant[done].all() and step < len(done):
            later = self.compose[done[step:].astype(np.uint16) * self.size + done[:-step]]
            done = np.concatenate([done[:step], later])
            step *= 2
        before = np.zeros(len(kind), dtype=np.uint8)
        before[1:] = self.value[done[:-1]]
        begin = self.begins[before.astype(np.uint8) * np.uint8(11) + kind]
        following = np.append(kind[1:], np.uint8(SEP))
        white = (kind == SPACE) | (kind == WHITE)
        begin |= white & (following != SPACE) & (following != WHITE) & (following != SEP)
        if (quoted := before == QUOTED).any():
            begin &= ~(quoted & (((kind == RV) & (following == EE)) | ((kind == ELL) & (following == ELL))))
        return np.flatnonzero(begin)


class Encoder:
    """A byte-level BPE vocabulary of ranks (a line each: the token in base64, and its id)."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (self.ranks[t[:i]] << 20 | self.ranks[t[i:]], r)
            for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        self.pairs, self.merged = (np.array(x, dtype=y) for x, y in zip(zip(*sorted(pairs), strict=True), (np.int64, np.int32), strict=True))
        self.scanner = Scanner()
        self.forget()

    def forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.flat, self.first, self.count = [], [0], 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that a pair merges into, which is also its rank; _NONE for a pair that doesn't merge."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == key), self.merged[at], _NONE)

    def merge(self, pieces: Sequence[bytes]) -> list[np.ndarray]:
        """The ids of each piece: the adjacent pair of least rank is merged until none is left, in all pieces at once."""
        out: list = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(sizes, kind="stable")
        done = 0
        while done < len(order):
            upto = done + 1
            width = max(16, int(sizes[order[done]]))
            while upto < len(order) and sizes[order[upto]] <= width and (upto - done) * width < 1 << 20:
                upto += 1
            chosen = order[done:upto]
            done = upto
            if width > 256:
                for i in chosen:
                    out[i] = self._merge_long(pieces[i])
                continue
            ids = np.full((len(chosen), width), -1, dtype=np.int32)
            mask = np.arange(width) < sizes[chosen][:, None]
            ids[mask] = self.of_byte[np.frombuffer(b"".join(pieces[i] for i in chosen), dtype=np.uint8)]
            rank = self._rank(ids[:, :-1], ids[:, 1:])
            rows = np.arange(len(chosen))
            result: list = [None] * len(chosen)
            while True:
                at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), int)
                best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
                open_ = best != _NONE
                for r, x in zip(rows[~open_], ids[~open_], strict=True):
                    result[r] = x[x >= 0]
                if not open_.any():
                    break
                ids, rank, at, best, rows = ids[open_], rank[open_], at[open_], best[open_], rows[open_]
                every, columns = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
                ids[every, at] = best
                ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
                columns = columns[:-1]
                rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), axis=1)
                if rank.shape[1]:
                    for place in (at - 1, at):
                        ok = (place >= 0) & (place < rank.shape[1])
                        e, p = every[ok], place[ok]
                        rank[e, p] = self._rank(ids[e, p], ids[e, p + 1])
            for i, x in zip(chosen, result, strict=True):
                out[i] = x
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One very long piece: a heap of pairs over a linked list, so that the time stays near linear."""
        import heapq

        parts: list = [self.ranks[piece[i : i + 1]] for i in range(len(piece))]
        ends = list(range(1, len(piece) + 1))
        before, after = list(range(-1, len(piece) - 1)), [*range(1, len(piece)), -1]
        start = list(range(len(piece)))
        heap: list = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := self.ranks.get(piece[start[i] : ends[j]])) is not None:
                heapq.heappush(heap, (r, i, ends[i], ends[j]))

        for i in range(len(piece) - 1):
            offer(i)
        while heap:
            r, i, end, upto = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or ends[i] != end or ends[j] != upto:
                continue
            parts[i], parts[j], ends[i], after[i] = r, None, upto, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([p for p in parts if p is not None], dtype=np.int32)

    def _learn(self, pieces: list[str]) -> None:
        whole, rest = [], []
        for piece in pieces:
            data = piece.encode("utf-8", "surrogatepass")
            (whole if data in self.ranks else rest).append((piece, data))
        for (piece, _), ids in zip(
            whole + rest, [np.array([self.ranks[d]], dtype=np.int32) for _, d in whole] + self.merge([d for _, d in rest]), strict=True
        ):
            self.cache[piece] = self.count
            self.count += 1
            self.flat.append(ids)
            self.first.append(self.first[-1] + len(ids))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with the bounds of each text, and the character offset and number of ids of each piece with
        the bounds of each text. Null and empty texts have no ids."""
        if self.count > CACHE_PIECES:
            self.forget()
        lengths = np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
        joined = "\n" + "\n".join(t or "" for t in texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
        begin = np.cumsum(np.append(0, lengths + 1))
        codes[begin] = 0x110000
        starts = self.scanner.starts(codes)
        text_of = np.searchsorted(begin, starts, side="right") - 1
        ends = np.append(starts[1:], len(codes) - 1)
        ends = np.minimum(ends, begin[text_of + 1])
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if new := {p for p in pieces if p not in self.cache}:
            self._learn(sorted(new))
        known = np.fromiter(map(self.cache.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        self.flat = [np.concatenate(self.flat)] if self.flat else []
        first = np.asarray(self.first, dtype=np.int64)
        sizes = first[known + 1] - first[known]
        upto = np.append(0, np.cumsum(sizes))
        at = np.repeat(first[known] - upto[:-1], sizes) + np.arange(upto[-1])
        ids = self.flat[0][at] if self.flat else np.zeros(0, np.int32)
        piece_bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
        return ids, upto[piece_bounds], starts - begin[text_of] - 1, sizes, piece_bounds

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, read once in each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32, copy=False)))


def encode_texts(rows: DataFrame, id_col: str, text: str, *, path: str = VOCABULARY, offsets: bool = False) -> DataFrame:
    """(id, ``ids``) of every row: the ids of its whole text without special tokens, an empty list for a null or empty text.

    With ``offsets`` also ``starts`` (the character at which each pre-token begins) and ``sizes`` (its number of ids).
    """
    rows = rows.select(id_col, F.col(text).cast("string").alias("_text"))
    lists = ["ids", "starts", "sizes"] if offsets else ["ids"]
    schema = T.StructType([rows.schema[id_col], *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in lists]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                ids, bounds, starts, sizes, pieces = own.encode(texts[lo:hi])
                columns = [_lists(bounds, ids), *([_lists(pieces, starts), _lists(pieces, sizes)] if offsets else [])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], [id_col, *lists])

    return rows.mapInArrow(run, schema)


def token_counts(rows: DataFrame, id_col: str, text: str, *, path: str = VOCABULARY) -> DataFrame:
    """(id, ``n``): the number of ids of every row's text."""
    rows = rows.select(id_col, F.col(text).cast("string").alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                bounds = own.encode(texts[lo:hi])[1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds))], [id_col, "n"])

    return rows.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, id_col: str, ids: str, *, path: str = VOCABULARY) -> DataFrame:
    """(id, ``text``): what the ids of each row stand for; an empty text for null."""
    rows = rows.select(id_col, F.col(ids).alias("_ids"))
    schema = T.StructType([rows.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [own.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return rows.mapInArrow(run, schema)
