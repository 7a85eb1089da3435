"""Word sets as tables, fixed-size statistics of all of them, and packed postings between tasks.

A set is a row (``key``: 64-bit hash of the set, ``n``, ``tokens``: its hashes, six bytes each). Postings travel as
binary columns, one row per task batch and target partition, so that the cost of a posting is a few bytes and a few
numpy operations rather than a row. Statistics over all sets live in tables of a fixed number of buckets, so what is
broadcast doesn't grow with the data; they only steer which signatures are chosen, never what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.wordsets import HASH_BITS, set_keys, slices, word_sets

BUCKET_BITS = 20
_SLICES = 64
_WIDTH = 6


def pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens).view(np.uint8).reshape(-1, 8)[:, :_WIDTH].tobytes()


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and tokens of a binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]].reshape(-1, _WIDTH)
    wide = np.zeros((len(data), 8), dtype=np.uint8)
    wide[:, :_WIDTH] = data
    return (offsets - offsets[0]) // _WIDTH, wide.reshape(-1).view(np.uint64)


def word_set_table(rows: DataFrame, carry: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """``carry`` columns, ``key``, ``n`` and ``tokens`` of the rows that have a word in any of ``texts`` (nulls are empty)."""
    rows = rows.select(*carry, *[F.col(t).cast("string").alias(f"_t{i}") for i, t in enumerate(texts)])
    schema = T.StructType([rows.schema[c] for c in carry] + [T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("tokens", T.BinaryType())])
    k = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.column(i).to_pylist() for i in range(k, batch.num_columns)]
            joined = parts[0] if len(parts) == 1 else [" ".join(x for x in t if x) for t in zip(*parts, strict=True)]
            for begin, end in slices(joined):
                bounds, tokens = word_sets(joined[begin:end])
                key, n = set_keys(bounds, tokens), np.diff(bounds)
                offsets = pa.py_buffer((bounds * _WIDTH).astype(np.int32).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), end - begin, [None, offsets, pa.py_buffer(pack(tokens))])
                own = [batch.column(i).slice(begin, end - begin) for i in range(k)]
                names = [*[batch.schema.names[i] for i in range(k)], "key", "n", "tokens"]
                out = pa.RecordBatch.from_arrays([*own, pa.array(key.view(np.int64)), pa.array(n.astype(np.int32)), packed], names)
                yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(run, schema)


def distinct_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, bounds and tokens of a batch, each set once: copies in a task count once before anything is shuffled."""
    keys = batch.column("key").to_numpy(zero_copy_only=False)
    _, first = np.unique(keys, return_index=True)
    if len(first) < len(keys):
        batch, keys = batch.take(pa.array(first)), keys[first]
    bounds, tokens = unpack(batch.column("tokens"))
    return keys, bounds, tokens


def sketches(bounds: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parity of each set's tokens in 128 buckets, as two words: two sets differ in at least as many tokens as bits."""
    if not len(tokens):
        return np.zeros(len(bounds) - 1, np.uint64), np.zeros(len(bounds) - 1, np.uint64)
    one, high = np.left_shift(np.uint64(1), tokens & np.uint64(63)), (tokens & np.uint64(64)) != 0
    low, up = np.where(high, np.uint64(0), one), np.where(high, one, np.uint64(0))
    return np.bitwise_xor.reduceat(low, bounds[:-1]), np.bitwise_xor.reduceat(up, bounds[:-1])


def bucket_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(HASH_BITS - BUCKET_BITS)).astype(np.int64)


def folded(sets: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], size: int, dtype: str, fold: str = "add") -> np.ndarray:
    """An array of ``size`` values to which every task adds its batches; tasks' arrays are folded ('add', 'maximum'
    or 'bitwise_or') slice by slice in executors. Only the one array, of fixed size, comes to the driver."""
    step = size // _SLICES

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, dtype=dtype)
        for batch in batches:
            add(own, batch)
        for i in range(_SLICES):
            part = own[i * step : (i + 1) * step]
            if len(at := np.flatnonzero(part)):
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "at": [at.astype(np.uint32).tobytes()], "value": [part[at].tobytes()]})

    def whole(t: pa.Table) -> pa.Table:
        out = np.zeros(step, dtype=dtype)
        for at, value in zip(t["at"].to_pylist(), t["value"].to_pylist(), strict=True):
            at = np.frombuffer(at, np.uint32)
            out[at] = getattr(np, fold)(out[at], np.frombuffer(value, dtype))
        return pa.table({"slice": t["slice"][:1], "value": [out.tobytes()]})

    parts = sets.mapInArrow(partial, "slice int, at binary, value binary").groupBy("slice").applyInArrow(whole, "slice int, value binary")
    result = np.zeros(size, dtype=dtype)
    for row in parts.collect():
        result[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(row["value"], dtype)
    return result


def document_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have a token, by bucket of tokens (sets that are equal and in one batch count once)."""

    def add(own: np.ndarray, batch: pa.RecordBatch) -> None:
        own += np.bincount(bucket_of(distinct_sets(batch)[2]), minlength=len(own)).astype(np.uint32)

    return folded(sets.select("key", "tokens"), add, 1 << BUCKET_BITS, "uint32")


def exchange(sets: DataFrame, emit: Callable, reduce: Callable, doc_type: np.dtype, value_type: type, partitions: int, extra: Sequence[str] = ()) -> DataFrame:
    """Candidate pairs (``a``, ``b``) of set keys.

    ``emit(batch)`` gives signatures (64 bits), the postings' destinations (64-bit hashes, equal for equal signatures), their
    document numbers and values (``value_type``), and the documents (``doc_type``, with a field ``key``). All postings of a
    signature meet in one partition, where
    ``reduce(sig, doc, value, docs)`` yields arrays of document numbers that are candidates.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, to, doc, value, docs = emit(batch)
            if not len(sig):
                continue
            part = ((to >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)
            order = np.argsort(part.astype(np.uint32 if partitions > 1 << 16 else np.uint16), kind="stable")
            part, low, doc, value = part[order], sig[order].astype(np.uint32), doc[order], value[order]
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            rows: dict[str, list] = {"part": [], "sig": [], "doc": [], "value": [], "docs": []}
            for lo, hi in zip(cuts, [*cuts[1:], len(part)], strict=True):
                used, place = np.unique(doc[lo:hi], return_inverse=True)
                rows["part"].append(int(part[lo]))
                rows["sig"].append(low[lo:hi].tobytes())
                rows["doc"].append(place.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes())
                rows["value"].append(value[lo:hi].tobytes())
                rows["docs"].append(docs[used].tobytes())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "part" else pa.binary()) for k, v in rows.items()})

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, at, values, docs, n = [], [], [], [], 0
        for batch in batches:
            for s, d, v, t in zip(*(batch.column(c).to_pylist() for c in ("sig", "doc", "value", "docs")), strict=True):
                t = np.frombuffer(t, doc_type)
                sigs.append(np.frombuffer(s, np.uint32))
                at.append(np.frombuffer(d, np.uint16 if len(d) < len(s) else np.uint32).astype(np.uint32) + np.uint32(n))
                values.append(np.frombuffer(v, value_type))
                docs.append(t)
                n += len(t)
        if not n:
            return
        table = np.concatenate(docs)
        _, first, same = np.unique(table[list(("key", *extra))] if extra else table["key"], return_index=True, return_inverse=True)
        table, doc = table[first], same.reshape(-1)[np.concatenate(at)]
        key = table["key"]
        for a, b in reduce(np.concatenate(sigs), doc, np.concatenate(values), table):
            lo, hi = np.minimum(key[a], key[b]), np.maximum(key[a], key[b])
            if len(lo):
                pairs = _unique_pairs(lo, hi)
                yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    sent = sets.mapInArrow(send, "part int, sig binary, doc binary, value binary, docs binary")
    return sent.repartitionById(partitions, F.col("part")).mapInArrow(receive, "a long, b long")


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    return np.stack([a[keep], b[keep]])


def partitions_for(sets: DataFrame, rows: int, per_task: int) -> int:
    """As many partitions as the session shuffles into, or more if a task would else get over ``per_task`` of ``rows``."""
    return max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task), 1)


def verified(sets: DataFrame, pairs: DataFrame, bitmap_bits: int = 24, weights: np.ndarray | None = None) -> DataFrame:
    """(``a``, ``b``, ``na``, ``nb``, ``common``, ``cosine``) of candidate ``pairs``, by the sets' whole contents: the exact dot
    product of the normed vectors whose terms weigh ``weights`` (by bucket), or the same.

    Sets that no pair names are dropped by a bitmap of fixed size before the join.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key"))

    def mark(own: np.ndarray, batch: pa.RecordBatch) -> None:
        bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << bitmap_bits) - 1)
        np.bitwise_or.at(own, (bits >> np.uint64(3)).astype(np.int64), np.left_shift(1, bits & np.uint64(7)).astype(np.uint8))

    wanted = sets.sparkSession.sparkContext.broadcast(folded(ends, mark, 1 << (bitmap_bits - 3), "uint8", "bitwise_or"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << bitmap_bits) - 1)
            hit = wanted.value[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    heavy = None if weights is None else sets.sparkSession.sparkContext.broadcast(weights)

    def squares(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        of = np.ones(len(tokens)) if heavy is None else heavy.value[bucket_of(tokens)].astype(np.float64) ** 2
        return np.add.reduceat(np.append(of, 0.0), bounds[:-1]) if len(bounds) > 1 else np.zeros(0)

    named = sets.select("key", "tokens").mapInArrow(keep, "key long, tokens binary").dropDuplicates(["key"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ba, ta), (bb, tb) = unpack(batch.column("ta")), unpack(batch.column("tb"))
            na, nb = np.diff(ba), np.diff(bb)
            out, dot = np.zeros(len(na), dtype=np.int32), np.zeros(len(na))
            for i in range(0, len(na), 1 << 14):  # the pair's number goes above the token's bits
                j = min(i + (1 << 14), len(na))
                pair = np.concatenate([np.repeat(np.arange(j - i), na[i:j]), np.repeat(np.arange(j - i), nb[i:j])]).astype(np.uint64)
                both = np.sort((pair << np.uint64(HASH_BITS)) | np.concatenate([ta[ba[i] : ba[j]], tb[bb[i] : bb[j]]]))
                hits = both[1:][both[1:] == both[:-1]]
                of = (hits >> np.uint64(HASH_BITS)).astype(np.int64)
                out[i:j] = np.bincount(of, minlength=j - i)
                if heavy is not None:
                    dot[i:j] = np.bincount(of, heavy.value[bucket_of(hits & np.uint64((1 << HASH_BITS) - 1))].astype(np.float64) ** 2, minlength=j - i)
            cosine = (out if heavy is None else dot) / np.sqrt(squares(ta, ba) * squares(tb, bb))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(na.astype(np.int32)), pa.array(nb.astype(np.int32)), pa.array(out), pa.array(cosine)],
                ["a", "b", "na", "nb", "common", "cosine"],
            )

    first = named.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    second = named.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    whole = pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb")
    return whole.mapInArrow(common, "a long, b long, na int, nb int, common int, cosine double")
