"""Problem 2: splits that keep related records together."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import joined, ranked
from tamiz.llm.forest import components
from tamiz.plans.durable import durable


def groups_of(rows: DataFrame, id_col: str, keys: Sequence[Column]) -> DataFrame:
    """(``id``, ``entity``): rows that share a value of any key, directly or through others, have one entity, named by the
    least of its keys.

    Keys are strings prefixed by their number, so values of different keys never meet; a row whose keys are all null
    is an entity of its own. The keys of a row are linked, and each task's links are reduced to a forest before anything
    is shuffled. Only rows whose first key isn't their entity's name are looked up.
    """
    named = [F.concat(F.lit(f"{i}:"), k.cast("string")) for i, k in enumerate(keys)]
    first = F.coalesce(*named, F.concat(F.lit("id:"), F.to_json(F.struct(id_col))))
    base = durable(rows.select(F.col(id_col).alias("id"), first.alias("_key"), F.array_compact(F.array(*named)).alias("_keys")))
    edges = base.filter(F.size("_keys") > 1).select("_key", F.explode(F.slice("_keys", 2, len(keys))).alias("other"))
    moved = components(edges).filter("node <> root")
    # A key of the last number is a row's first only if all others are null.
    needed = base.select("_key").filter(~F.col("_key").startswith("0:")).distinct() if len(keys) > 1 else None
    if needed is not None:
        moved = moved.filter(F.col("node").startswith("0:")).unionByName(moved.filter(~F.col("node").startswith("0:")).join(needed, F.col("node") == F.col("_key"), "left_semi"))
    moved = durable(moved.select(F.col("node").alias("_key"), "root"))
    return joined(base.select("id", "_key"), moved, ["_key"], "left").select("id", F.coalesce("root", "_key").alias("entity"))


def greedy_counts(sizes: dict[int, int], targets: dict[str, float]) -> dict[int, list[tuple[str, int]]]:
    """For each group size, how many of its groups go to each split, when the groups, largest first, go one by one to
    the split furthest below its target (ties: the order of ``targets``). Groups of one size are interchangeable, and
    sizes are at most the square root of twice the rows, so this is small whatever the number of groups."""
    heap = [(-t, i) for i, t in enumerate(targets.values())]
    names, out = list(targets), {}
    heapq.heapify(heap)
    for size in sorted(sizes, reverse=True):
        left, given = sizes[size], [0] * len(names)
        while left:
            gap, i = heapq.heappop(heap)
            n = 1
            if heap and (lead := heap[0][0] - gap) > size:
                n = min(left, int(lead // size))
            elif left > 4 * len(names) and heap and max(heap)[0] - gap < size:
                heapq.heappush(heap, (gap, i))
                cycles = left // len(names) - 1
                heap = [(g + cycles * size, j) for g, j in heap]
                heapq.heapify(heap)
                given = [x + cycles for x in given]
                left -= cycles * len(names)
                continue
            given[i] += n
            left -= n
            heapq.heappush(heap, (gap + n * size, i))
        out[size] = [(names[i], n) for i, n in enumerate(given) if n]
    return out


def assign_splits(rows: DataFrame, id_col: str, keys: Sequence[Column], ratios: dict[str, float]) -> DataFrame:
    """(``id``, ``entity``, ``new_split``): all rows of an entity in one split, sizes as near ``ratios`` as greedy
    largest-first assignment comes. Ratios must be at least 0 and are scaled to sum to 1; an empty table gives an
    empty result. Groups of one size are told apart by their entity, ascending."""
    if not ratios or min(ratios.values()) < 0 or sum(ratios.values()) <= 0:
        raise ValueError("ratios must be non-negative and not all 0")
    members = durable(groups_of(rows, id_col, keys))
    groups = members.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["n"]: r["c"] for r in groups.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    total, whole = sum(n * c for n, c in sizes.items()), sum(ratios.values())
    plan = greedy_counts(sizes, {k: total * v / whole for k, v in ratios.items()})
    bounds = [(size, upto - n, upto, split) for size, given in plan.items() for split, n, upto in _upto(given)]
    spark = rows.sparkSession
    table = spark.createDataFrame(bounds, "size long, after long, upto long, new_split string")
    placed = ranked(groups, ["n"], [F.col("entity").asc()])
    within = (F.col("n") == F.col("size")) & (F.col("rank") > F.col("after")) & (F.col("rank") <= F.col("upto"))
    chosen = placed.join(table, within).select("entity", "new_split")
    return joined(members, durable(chosen), ["entity"]).select("id", "entity", "new_split")


def _upto(given: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    out, upto = [], 0
    for split, n in given:
        upto += n
        out.append((split, n, upto))
    return out


def torn_entities(rows: DataFrame, id_col: str, keys: Sequence[Column], split: Column) -> DataFrame:
    """(``entity``, ``splits``): the entities whose rows lie in more than one split now; rows without one don't count."""
    have = rows.select(F.struct(F.col(id_col), split.alias("s")).alias("_id"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)]).filter("_id.s is not null")
    of = groups_of(have, "_id", [F.col(f"_k{i}") for i in range(len(keys))])
    per = of.groupBy("entity").agg(F.sort_array(F.collect_set("id.s")).alias("splits"))
    return per.filter(F.size("splits") > 1)
