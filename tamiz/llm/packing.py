"""Problem 8: filling containers of fixed capacity with items of varying length."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.plans.durable import durable

#: Items packed together by one task. A task wastes at most a few containers at the end of its block, so blocks of
#: this many items fill as well as one pool would, whatever the number of items.
BLOCK_ITEMS = 100_000


def pack(sizes: np.ndarray, capacities: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bin number of each item and capacity of each bin, for items no larger than the largest capacity.

    The largest item left opens a bin. For every permitted capacity that holds it, the bin is filled best-fit: the item
    that leaves the least space goes in, again and again. The capacity that wastes the smallest share of itself is
    opened (ties: the largest); at the end each bin shrinks to the least capacity that holds its contents. Items of
    size 0 go into the last bin.
    """
    capacities = sorted(set(capacities))
    top = capacities[-1]
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    left = np.bincount(ordered, minlength=top + 1).tolist()
    end = np.cumsum(np.bincount(ordered, minlength=top + 1)).tolist()
    # below[s]: the largest size <= s with items left, found by following links past exhausted sizes.
    below = list(range(top + 1))

    def fit(s: int) -> int:
        path = []
        while s > 0 and not left[s]:
            path.append(s)
            s = below[s - 1] if below[s] == s else below[s]
        for p in path:
            below[p] = s
        return s

    bins = np.zeros(len(sizes), dtype=np.int64)
    sizes_of_bins: list[int] = []
    while first := fit(top):
        best: tuple | None = None
        for capacity in capacities:
            if capacity < first:
                continue
            chosen, room, taken = [first], capacity - first, {first: 1}
            while room > 0:
                s = fit(room)
                while s > 0 and taken.get(s, 0) >= left[s]:
                    s = fit(s - 1)
                if s <= 0:
                    break
                chosen.append(s)
                taken[s] = taken.get(s, 0) + 1
                room -= s
            if best is None or (room / capacity, -capacity) < best[:2]:
                best = (room / capacity, -capacity, chosen)
        for s in best[2]:
            left[s] -= 1
            end[s] -= 1
            bins[order[end[s]]] = len(sizes_of_bins)
        used = sum(best[2])
        sizes_of_bins.append(next(c for c in capacities if c >= used))
    if left[0]:
        if not sizes_of_bins:
            sizes_of_bins.append(capacities[0])
        bins[order[: left[0]]] = len(sizes_of_bins) - 1
    return bins, np.array(sizes_of_bins, dtype=np.int64)


def pack_jointly(sizes: np.ndarray, capacities: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`pack`, by the one of all sets of permitted capacities that hold every item with which the containers take the
    least space together (ties: the fewest containers): what is best bin by bin needn't be best for all."""
    capacities = sorted(set(capacities))
    largest = int(sizes.max(initial=0))
    best = None
    for mask in range(1, 1 << len(capacities)):
        chosen = [c for i, c in enumerate(capacities) if mask >> i & 1]
        if chosen[-1] < largest:
            continue
        bins, opened = pack(sizes, chosen)
        # Downsizing: every container shrinks to the least permitted capacity that holds its contents.
        held = np.bincount(bins, weights=sizes, minlength=len(opened)) if len(opened) else np.zeros(0)
        opened = np.array(capacities, dtype=np.int64)[np.searchsorted(capacities, held)] if len(opened) else opened
        cost = (int(opened.sum()), len(opened))
        if best is None or cost < best[0]:
            best = (cost, bins, opened)
    return best[1], best[2]


def fill_containers(items: DataFrame, id_col: str, size_col: str, capacities: Sequence[int], block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(``container_id``, ``capacity``, id, ``item_start``, ``item_end``, ``position``): what each container holds.

    Only an item larger than the largest capacity is cut: into pieces that fill containers of their own, and a rest
    that is placed like any item. ``item_start`` and ``item_end`` are the piece's bounds within its item,
    ``position`` its place in the container. Items of size 0 (or null) take no space but are placed too. Ids need not be
    unique or non-null: each row is an item. An empty table has no containers.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    capacities = tuple(sorted(set(capacities)))
    items = durable(items.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0)).alias("n")))
    blocks = max(1, -(-items.count() // block_items))
    kind = items.schema["id"]
    schema = T.StructType([
        T.StructField("container_id", T.LongType()), T.StructField("capacity", T.IntegerType()), T.StructField(id_col, kind.dataType),
        T.StructField("item_start", T.LongType()), T.StructField("item_end", T.LongType()), T.StructField("position", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held).sort_by([("n", "descending"), ("id", "ascending")])
        block, n = whole["block"][0].as_py(), whole["n"].to_numpy()
        top = capacities[-1]
        full, rest = n // top, n % top
        rest_items = np.flatnonzero((rest > 0) | (n == 0))
        bins, sizes = pack_jointly(rest[rest_items], capacities)
        pieces = np.repeat(np.arange(len(n)), full)
        inside = np.arange(len(pieces)) - np.repeat(np.cumsum(full) - full, full)
        item = np.concatenate([pieces, rest_items])
        start = np.concatenate([inside * top, full[rest_items] * top])
        end = np.concatenate([(inside + 1) * top, n[rest_items]])
        number = np.concatenate([np.arange(len(pieces)), bins + len(pieces)])
        size = np.concatenate([np.full(len(pieces), top), sizes])
        order = np.lexsort((-(end - start), number))
        item, start, end, number = item[order], start[order], end[order], number[order]
        before = np.append(0, np.cumsum(end - start))[:-1]
        opens = np.append(True, number[1:] != number[:-1]) if len(number) else np.zeros(0, bool)
        position = before - np.repeat(before[opens], np.diff(np.append(np.flatnonzero(opens), len(number))))
        for lo in range(0, len(item), 50_000):
            cut = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number[cut] + (block << 40)), pa.array(size[number[cut]].astype(np.int32)),
                    whole["id"].take(pa.array(item[cut])).combine_chunks(), pa.array(start[cut]), pa.array(end[cut]), pa.array(position[cut].astype(np.int32)),
                ],
                schema.names,
            )

    block = F.pmod(F.xxhash64("id", "n"), F.lit(blocks)).cast("int")
    return items.withColumn("block", block).repartitionById(blocks, F.col("block")).mapInArrow(run, schema)
