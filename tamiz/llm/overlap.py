"""Problem 3: the same or nearly the same records across splits, by a weighted cosine join.

Each text is a vector of term weights with norm 1, its terms ordered from rare to common. Only the terms up to which
the norm of the rest (the residual) still reaches the threshold are put into the inverted lists: a pair whose first
common term comes later can't reach it. The bound is sharpened by the largest weight that a term has on the other
side, and a list yields only pairs whose two residual norms multiply to the threshold. Where all terms weigh the same, a 128-bit sketch of each set must
allow the threshold too. Candidates then get their exact dot product (``cosine_pairs``), or the overlap of their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.postings import BUCKET_BITS, bucket_of, document_counts, exchange, folded, partitions_for, sketches, unpack, verified
from tamiz.llm.wordsets import mix
from tamiz.plans.durable import durable

_DOC = np.dtype([("key", np.int64), ("side", np.uint8), ("n", np.int32), ("s0", np.uint64), ("s1", np.uint64)])
_SCALE = float(1 << 28)


def _vectors(batch: pa.RecordBatch, counts: np.ndarray, idf: np.ndarray | None) -> tuple:
    """Distinct (key, side) of a batch: documents, bounds, and tokens and weights from rare to common."""
    keys, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "side"))
    _, first = np.unique(np.stack([keys, side.astype(np.int64)]), axis=1, return_index=True)
    batch = batch.take(pa.array(first))
    docs = np.zeros(len(first), dtype=_DOC)
    docs["key"], docs["side"] = keys[first], side[first]
    bounds, tokens = unpack(batch.column("tokens"))
    docs["n"] = np.diff(bounds)
    docs["s0"], docs["s1"] = sketches(bounds, tokens)
    owner = np.repeat(np.arange(len(docs)), np.diff(bounds))
    bucket = bucket_of(tokens)
    order = np.lexsort((tokens, counts[bucket], owner))
    tokens, bucket = tokens[order], bucket[order]
    weight = np.ones(len(tokens)) if idf is None else idf[bucket].astype(np.float64)
    norm = np.sqrt(np.add.reduceat(weight**2, bounds[:-1])) if len(tokens) else np.zeros(0)
    return docs, bounds, owner, tokens, bucket, weight / norm[owner]


def _rest(values: np.ndarray, bounds: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each place the sum of ``values`` from there to the end of its document."""
    upto = np.append(0.0, np.cumsum(values))
    return upto[bounds[1:]][owner] - upto[:-1]


def _statistics(sets: DataFrame, weights: str) -> tuple[np.ndarray, int, np.ndarray | None]:
    counts, total = document_counts(sets), sets.count()
    return counts, total, None if weights == "unit" else np.log1p(max(total, 1) / np.maximum(counts, 1)).astype(np.float32)


def cosine_pairs(sets: DataFrame, threshold: float, weights: str = "idf") -> DataFrame:
    """(``a``, ``b``, ``cosine``): all pairs of set keys found on different sides whose weighted cosine is at least ``threshold``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    pairs = durable(cosine_candidates(sets, threshold, weights))
    found = verified(sets, pairs, weights=_statistics(sets, weights)[2])
    return found.filter(F.col("cosine") >= threshold - 1e-9).select("a", "b", "cosine")


def cosine_candidates(sets: DataFrame, threshold: float, weights: str = "unit") -> DataFrame:
    """Pairs (``a``, ``b``) of set keys, one with ``side`` 0 and one with 1, among which are all whose cosine is at
    least ``threshold``. ``weights``: 'unit', or 'idf' for log(1 + N / document frequency of the term's bucket)."""
    sc = sets.sparkSession.sparkContext
    if weights not in ("unit", "idf"):
        raise ValueError(f"unknown weights: {weights}")
    counts, total, idf = _statistics(sets, weights)
    stats = sc.broadcast((counts, idf))
    sides = 1 << BUCKET_BITS

    def largest(own: np.ndarray, batch: pa.RecordBatch) -> None:
        docs, _, owner, _, bucket, weight = _vectors(batch, *stats.value)
        np.maximum.at(own, docs["side"][owner].astype(np.int64) * sides + bucket, weight.astype(np.float32) + np.float32(1e-6))

    rows = sets.select("key", "side", "tokens")
    most = sc.broadcast(folded(rows, largest, 2 * sides, "float32", "maximum"))

    def emit(batch: pa.RecordBatch) -> tuple:
        docs, bounds, owner, tokens, bucket, weight = _vectors(batch, *stats.value)
        residual = np.sqrt(np.maximum(_rest(weight**2, bounds, owner), 0))
        reach = _rest(weight * most.value[(1 - docs["side"][owner].astype(np.int64)) * sides + bucket], bounds, owner)
        there = most.value[(1 - docs["side"][owner].astype(np.int64)) * sides + bucket] > 0
        use = there & (np.minimum(residual, reach) >= threshold - 1e-6)
        sig = mix(tokens[use])
        return sig, sig, owner[use], np.minimum(residual[use] * _SCALE, _SCALE).astype(np.uint32), docs

    def reduce(sig: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        side, residual = docs["side"][doc], value / _SCALE
        names, group = np.unique(sig, return_inverse=True)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        # Right postings by list and falling residual, so that those a left posting can reach are a prefix.
        place = group[right] * 4.0 - residual[right]
        order = np.argsort(place, kind="stable")
        right, place = right[order], place[order]
        begin = np.searchsorted(place, group[left] * 4.0 - 2)
        need = (threshold - 1e-6) / np.maximum(residual[left], 1e-9)
        many = np.searchsorted(place, group[left] * 4.0 - need, side="right") - begin
        left, begin, many = left[many > 0], begin[many > 0], many[many > 0]
        done = 0
        upto = np.cumsum(many)
        while done < len(left):
            last = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + (1 << 21), side="right")))
            n = many[done:last]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            a, b = doc[np.repeat(left[done:last], n)], doc[right[np.repeat(begin[done:last], n) + inside]]
            if idf is None:  # equal weights: a cosine bounds the number of terms that differ, and a sketch bounds it from below
                na, nb = docs["n"][a], docs["n"][b]
                odd = np.bitwise_count(docs["s0"][a] ^ docs["s0"][b]) + np.bitwise_count(docs["s1"][a] ^ docs["s1"][b])
                ok = odd <= na + nb - 2 * (threshold - 1e-6) * np.sqrt(na * nb)
                a, b = a[ok], b[ok]
            yield a, b
            done = last

    return exchange(rows, emit, reduce, _DOC, np.uint32, partitions_for(sets, total, 400_000), extra=("side",)).distinct()


def cross_split_overlaps(sets: DataFrame, overlap: float) -> DataFrame:
    """(``a``, ``b``, ``common``, ``na``, ``nb``, ``cosine``): pairs of set keys found on different sides (``side`` 0 and 1 of
    ``sets``) whose overlap (Jaccard) is at least ``overlap``; a set found on both sides pairs with itself.

    Words weigh the same here, as overlap counts them; an overlap of ``t`` then means a cosine of ``2t/(1+t)`` at least.
    """
    if not 0 < overlap <= 1:
        raise ValueError("overlap must be in (0, 1]")
    pairs = durable(cosine_candidates(sets, 2 * overlap / (1 + overlap)))
    found = verified(sets, pairs)
    return found.filter(F.col("common") >= F.lit(overlap) * (F.col("na") + F.col("nb") - F.col("common")) - 1e-9)
