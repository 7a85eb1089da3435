import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from tamiz.llm import capping, common, ranking, splits
from tamiz.llm.common import exact_medians, records, source_of, split_of


def test_records_take_the_earliest_delivery(spark):
    rows = [("q1", 5, "late"), ("q1", 2, None), ("q2", 1, "x"), (None, 0, "no")]
    got = {r["qa_id"]: r["v"] for r in records(spark.createDataFrame(rows, "qa_id string, row_no long, v string").withColumn("_row", F.lit(1)), v=F.col("v")).collect()}
    assert got == {"q1": None, "q2": "x"}


def test_sources_and_splits(spark):
    rows = [("a_b_00012", " TRAIN "), ("x", "dev"), (None, "Testing"), ("_1", "otro"), ("s_1_2", None)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "chunk_id string, split string").select(source_of(), split_of()).collect()]
    assert got == [("a_b", "train"), (None, "validation"), (None, "test"), (None, None), ("s_1", None)]


def test_medians_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 4), 3.0, None]), float(rng.randrange(3)), None, 7.0) for _ in range(1001)]
    got = exact_medians(spark.createDataFrame(rows, "a double, b double, c double, d double"), ["a", "b", "c", "d"], buckets=8)
    assert got["a"] == median(r[0] for r in rows if r[0] is not None) and got["b"] == median(r[1] for r in rows) and got["c"] is None and got["d"] == 7.0
    even = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "a double")
    assert exact_medians(even, ["a"]) == {"a": 3.0} and exact_medians(even.filter("false"), ["a"]) == {"a": None}


def test_cap_keeps_the_best_of_a_hot_source(spark):
    rng = random.Random(2)
    rows = [(f"q{i:04d}", "hot" if i < 400 else f"s{i % 90}" if i < 980 else None, rng.choice([None, *range(6)])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, source string, score int")
    out = {r["id"] for r in capping.over_cap(df, "id", F.col("source"), F.col("score"), share=0.02).collect()}
    wanted = set()
    for s in {r[1] for r in rows if r[1]}:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        wanted |= {r[0] for r in own[20:]}
    assert out == wanted
    kept = capping.cap_contributors(df, "id", F.col("source"), F.col("score"), share=0.02)
    assert {r["id"] for r in kept.filter("not kept").collect()} == wanted and kept.count() == 1000
    assert capping.over_cap(df.filter("false"), "id", F.col("source"), F.col("score"), share=0.02).count() == 0


@pytest.mark.parametrize(("weights", "sizes", "cap", "slots"), [
    ("size", {"a": 50, "b": 30, "c": 20}, 10, {"a": 5, "b": 3, "c": 2}), ("size", {"a": 5, "b": 5, "c": 5}, 4, {"a": 2, "b": 1, "c": 1}),
    ("equal", {"a": 50, "b": 30, "c": 1}, 9, {"a": 4, "b": 4, "c": 1}), ("equal", {"a": 50, "b": 2, "c": 1}, 20, {"a": 17, "b": 2, "c": 1}),
    ("equal", {"a": 7, "b": 7, "c": 7}, 11, {"a": 4, "b": 4, "c": 3}), ("size", {"a": 3}, 3, {}), ("size", {"a": 3}, 0, {"a": 0}),
])
def test_quotas(spark, weights, sizes, cap, slots):
    df = spark.createDataFrame([("x", s, n) for s, n in sizes.items()], "contributor string, stratum string, n long")
    assert {r["stratum"]: r["slots"] for r in capping.quotas(df, cap, weights).collect()} == slots


def by_hand(sizes, targets):
    gap, order, out = dict(targets), list(targets), []
    for s in sorted(sizes, reverse=True):
        best = max(order, key=lambda k: (gap[k], -order.index(k)))
        gap[best] -= s
        out.append((s, best))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy_counts_are_those_one_by_one(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 1, 2, 3, 10, 50]) for _ in range(500)]
    targets = {"train": sum(sizes) * 0.8, "validation": sum(sizes) * 0.1, "test": sum(sizes) * 0.1}
    got = splits.greedy_counts({s: sizes.count(s) for s in set(sizes)}, targets)
    wanted = by_hand(sizes, targets)
    for s in set(sizes):
        assert dict(got[s]) == {k: n for k in targets if (n := wanted.count((s, k)))}


def test_related_records_share_a_split(spark):
    rng = random.Random(5)
    rows = [(i, f"s{min(rng.randrange(40), rng.randrange(40))}" if rng.random() < 0.95 else None, f"a{rng.randrange(400)}" if rng.random() < 0.05 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, source string, author string")
    for keys in ([F.col("source")], [F.col("source"), F.col("author")]):
        got = {r["id"]: (r["entity"], r["new_split"]) for r in splits.assign_splits(df, "id", keys, {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()}
        assert len(got) == 1500
        for column in range(1, len(keys) + 1):
            for value in {r[column] for r in rows if r[column]}:
                assert len({got[r[0]][1] for r in rows if r[column] == value}) == 1
    assert splits.assign_splits(df.filter("false"), "id", [F.col("source")], {"train": 1.0}).count() == 0
    with pytest.raises(ValueError):
        splits.assign_splits(df, "id", [F.col("source")], {"train": -1.0})


def test_torn_sources(spark):
    rows = [(1, "s", "train"), (2, "s", "test"), (3, "t", "train"), (4, "t", None), (5, None, "test"), (6, None, "train")]
    df = spark.createDataFrame(rows, "id long, source string, split string")
    assert [(r["entity"], r["splits"]) for r in splits.torn_entities(df, "id", [F.col("source")], F.col("split")).collect()] == [("0:s", ["test", "train"])]


def test_combined_ranking(spark):
    rng = random.Random(6)
    rows = [(i, rng.random(), rng.lognormvariate(0, 2) * 1000, rng.gauss(5, 1e-3)) for i in range(400)] + [(900, None, 1.0, 1.0), (901, float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: r["combined"] for r in ranking.combined_scores(df, "id", {"a": 1.0, "b": 1.0, "c": 2.0}).collect()}
    good = rows[:400]
    scale = []
    for k in (1, 2, 3):
        m = median(r[k] for r in good)
        scale.append((m, 1.4826 * median(abs(r[k] - m) for r in good)))
    for r in good:
        z = [max(-30, min(30, (r[k + 1] - m) / s)) for k, (m, s) in enumerate(scale)]
        assert got[r[0]] == pytest.approx(math.exp(sum(w * -math.log1p(math.exp(-x)) for w, x in zip((1, 1, 2), z, strict=True)) / 4), rel=1e-9)
    assert len(got) == 400
    top = ranking.best(ranking.combined_scores(df, "id", {"a": 1.0}), 0.1).collect()
    assert {r["id"] for r in top} == {r[0] for r in sorted(good, key=lambda r: (-r[1], r[0]))[:40]}


def test_flat_and_missing_scores(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0), (3, 5.0, 3.0)], "id long, a double, b double")
    got = {r["id"]: r["rank"] for r in ranking.best(ranking.combined_scores(df, "id", {"a": 1.0, "b": 1.0})).collect()}
    assert got == {3: 1, 2: 2, 1: 3}
    assert ranking.combined_scores(df.filter("false"), "id", {"a": 1.0}).count() == 0


def test_a_table_too_large_to_broadcast_is_salted(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(200)], "id long, key string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("none", 3)], "key string, value int")
    assert common.joined(rows, table, ["key"]).count() == 134 and common.joined(rows, table, ["key"], "left").filter("value is null").count() == 66


def test_the_best_share_ranks_only_what_can_be_in_it(spark):
    rows = spark.createDataFrame([(f"i{i:04d}", (i * 7919 % 1000) / 1000) for i in range(1000)] + [("z", 0.999), ("a", 0.999)], "id string, combined double")
    got = [(r["id"], r["rank"]) for r in ranking.best(rows, 0.05).orderBy("rank").collect()]
    want = sorted(((r["id"], r["combined"]) for r in rows.collect()), key=lambda x: (-x[1], x[0]))[:50]
    assert got == [(i, k + 1) for k, (i, _) in enumerate(want)]
    assert ranking.best(rows.filter("false"), 0.05).count() == 0
