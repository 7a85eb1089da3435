import math
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import fuzzy, overlap, postings
from tamiz.llm.forest import components
from tamiz.llm.wordsets import set_keys, slices, word_hashes, word_sets, words_in_order


def words(t):
    t = "".join(c for c in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(c)).lower()
    return re.findall("[a-z0-9]+", t)


TEXTS = [None, "", "ß ﬁ ½ ²x İstanbul á̈b K 𝒜b " + "x" * 200, "a a b", "B a", "\x00a\x00b", "no-one", "día día", "漢字 только", "9 nueve", "é"]


def test_word_sets_are_those_by_hand():
    bounds, tokens = word_sets(TEXTS)
    assert np.diff(bounds).tolist() == [len(set(words(t))) for t in TEXTS]
    keys = set_keys(bounds, tokens)
    assert keys[3] == keys[4] == keys[5] and keys[0] == keys[1] == 0 and keys[6] != keys[7]
    assert np.bincount(word_hashes(TEXTS)[0], minlength=len(TEXTS)).tolist() == [len(words(t)) for t in TEXTS]
    assert len(set(word_hashes(["x" * 40 + "y" + "x" * 31, "x" * 8 + "y" + "x" * 63])[1].tolist())) == 2


def test_words_know_digits_and_stops():
    _, _, digit, stop = words_in_order(["a 1b. c! d", "e"])
    assert digit.tolist() == [False, True, False, False, False] and stop.tolist() == [False, True, True, False, False]


def test_slices_cover_all():
    texts = ["a" * random.Random(i).randrange(50) for i in range(100)] + [None, "b" * 500]
    parts = list(slices(texts, 100))
    assert parts[0][0] == 0 and parts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))


def corpus(seed, n=250):
    """Texts with common and rare words, edited copies, exact copies, short and empty texts."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.35:
            base = rng.choice(out)[:] or ["vacio"]
            for _ in range(rng.randrange(0, max(1, len(base) // 4 + 1))):
                base[rng.randrange(len(base))] = rng.choice([rng.choice(common), f"n{rng.randrange(10**6)}"])
            rng.shuffle(base)
            out.append(base)
        elif kind < 0.45:
            out.append([rng.choice(common) for _ in range(rng.randrange(0, 6))])
        elif kind < 0.6:
            out.append(rng.sample(common, 25))
        else:
            out.append(rng.sample(common, 12) + [f"r{rng.randrange(3000)}" for _ in range(rng.randrange(0, 12))])
    return [" ".join(x) for x in out]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.7), (2, 0.7), (3, 0.5), (4, 0.85), (5, 1.0)])
def test_similar_sets_lose_no_link(spark, seed, threshold):
    texts = corpus(seed)
    sets = postings.word_set_table(spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(3), ["i"], ["t"]).persist()
    key = {r["i"]: r["key"] for r in sets.collect()}
    by_key = {k: set(words(texts[i])) for i, k in key.items()}
    wanted = {(a, b) for a in by_key for b in by_key if a < b and jaccard(by_key[a], by_key[b]) >= threshold - 1e-9}
    found = fuzzy.similar_sets(sets, threshold).collect()
    assert {(r["a"], r["b"]) for r in found} == wanted
    assert all(r["common"] == len(by_key[r["a"]] & by_key[r["b"]]) for r in found)


@pytest.mark.parametrize("pairs", [0.0, 5.0, 1e9])
def test_any_allocation_finds_the_same(spark, monkeypatch, pairs):
    texts = corpus(7, 150)
    kinds = fuzzy.word_kinds
    monkeypatch.setattr(fuzzy, "word_kinds", lambda counts, n: kinds(counts, n, pairs, 8.0))
    sets = postings.word_set_table(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), ["i"], ["t"]).persist()
    by_key = {r["key"]: set(words(texts[r["i"]])) for r in sets.collect()}
    wanted = {(a, b) for a in by_key for b in by_key if a < b and jaccard(by_key[a], by_key[b]) >= 0.7 - 1e-9}
    assert {(r["a"], r["b"]) for r in fuzzy.similar_sets(sets, 0.7).collect()} == wanted


@pytest.mark.parametrize(("seed", "threshold", "colour"), [(31, 0.7, 128), (32, 0.7, 4), (33, 0.5, 2), (34, 0.85, 8), (35, 1.0, 4)])
def test_pairs_of_scarce_words_lose_no_link(spark, monkeypatch, seed, threshold, colour):
    """Words too frequent to be compared one by one: pairs of them, also in sets long enough for colours, beside other classes."""
    kinds = fuzzy.word_kinds
    monkeypatch.setattr(fuzzy, "word_kinds", lambda counts, n: kinds(counts, n, seed % 2 / 4, 30.0))
    for name, value in (("SCARCE_SHARE", 0.45), ("SCARCE_WORDS", 1e9), ("SCARCE_PAIRS", 1e9), ("COLOUR_WORDS", colour)):
        monkeypatch.setattr(fuzzy, name, value)
    texts = corpus(seed)
    sets = postings.word_set_table(spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(3), ["i"], ["t"]).persist()
    counts = postings.document_counts(sets)
    assert (fuzzy.word_kinds(counts, sets.count()) == 4).sum() > 20
    by_key = {r["key"]: set(words(texts[r["i"]])) for r in sets.collect()}
    wanted = {(a, b) for a in by_key for b in by_key if a < b and jaccard(by_key[a], by_key[b]) >= threshold - 1e-9}
    assert {(r["a"], r["b"]) for r in fuzzy.similar_sets(sets, threshold).collect()} == wanted


def test_comparisons_a_set_stay_bounded_as_sets_grow(monkeypatch):
    """Texts of frequent sentences that name eight of 2,000 things: pairs compared a set at 16,000 texts are at most twice those
    at 4,000. With single words and segments alone they grow as the texts do (35 and 119)."""
    monkeypatch.setattr(fuzzy, "SCARCE_SHARE", 0.01, raising=False)

    def compared(n):
        rng = np.random.default_rng(3)
        sentences = rng.integers(0, 40, (n, 5))
        things = rng.integers(0, 2000, (n, 8))
        texts = [" ".join([*(f"s{x}w{i}" for x in a for i in range(8)), *(f"n{x}" for x in b)]) for a, b in zip(sentences, things, strict=True)]
        bounds, tokens = word_sets(texts)
        counts = np.bincount(postings.bucket_of(tokens), minlength=1 << postings.BUCKET_BITS)
        rarity = np.rint(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
        plan = fuzzy.Allocation(0.7, fuzzy.word_kinds(counts, n, 5.0), rarity)
        batch = pa.RecordBatch.from_pydict({"key": pa.array(np.arange(n)), "tokens": [postings.pack(tokens[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]})
        budget = fuzzy._read(plan, batch)[5]
        plan = fuzzy.Allocation(0.7, plan.kinds, rarity, fuzzy.choose_bands(np.bincount(np.maximum(budget, 0).astype(int))))
        sig, _, _, value, _ = fuzzy._emit(plan, None)(batch)
        whole, deleted = (np.unique(sig[value % 2 == v], return_counts=True) for v in (0, 1))
        both = np.intersect1d(whole[0], deleted[0], return_indices=True)
        return ((whole[1] * (whole[1] - 1.0) / 2).sum() + (whole[1][both[1]] * 1.0 * deleted[1][both[2]]).sum()) / n

    few, many = compared(4000), compared(16000)
    assert many <= 2 * few, (few, many)


def test_sets_of_any_budget_keep_their_links(spark, monkeypatch):
    """Long texts with no rare word, whose budgets (over 5,000) are above the histogram's last bucket, beside short ones."""
    kinds = fuzzy.word_kinds
    monkeypatch.setattr(fuzzy, "word_kinds", lambda counts, n: kinds(counts, n, 0.0, 1e9))
    rng = random.Random(13)
    base = [f"w{i}" for i in range(34000)]
    texts = [" ".join(base), *(" ".join(w for w in base if rng.random() > 0.07) for _ in range(3)), *corpus(14, 60)]
    sets = postings.word_set_table(spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(2), ["i"], ["t"]).persist()
    by_key = {r["key"]: set(words(texts[r["i"]])) for r in sets.collect()}
    wanted = {(a, b) for a in by_key for b in by_key if a < b and jaccard(by_key[a], by_key[b]) >= 0.7 - 1e-9}
    assert sum(len(by_key[a]) > 30000 for a, _ in wanted) == 6
    assert {(r["a"], r["b"]) for r in fuzzy.similar_sets(sets, 0.7).collect()} == wanted
    assert fuzzy.choose_bands(np.array([1, 0, 1]), 5000)[-1] == 5001


def test_groups_join_copies_and_chains(spark):
    base = [f"w{i}" for i in range(20)]
    rows = [("a", 1, " ".join(base)), ("b", 2, " ".join(base[2:] + ["x", "y"])), ("c", 3, " ".join(base[4:] + ["x", "y", "z", "u"])), ("d", 4, "solo"), ("e", 5, "SOLO"), ("f", 6, None), ("g", 7, ""), ("a", 9, "otra cosa"), (None, 8, "solo")]
    df = spark.createDataFrame(rows, "id string, row long, t string").withColumn("key", F.lit("clash")).withColumn("n", F.lit(1))
    groups = fuzzy.near_duplicate_groups(postings.word_set_table(df, ["id", "row"], ["t"]), "id", "row", 0.7)
    assert {(r["a"], r["b"]) for r in fuzzy.pairs_of(groups).collect()} == {("a", "b"), ("a", "c"), ("b", "c"), ("d", "e")}
    empty = postings.word_set_table(df.filter("false"), ["id", "row"], ["t"])
    assert fuzzy.near_duplicate_groups(empty, "id", "row", 0.7).count() == 0


@pytest.mark.parametrize("limit", [10**6, 0])
def test_components(spark, limit):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, 200 + i) for i in range(80)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, None), (9, 9)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and root(a) != root(b):
            up[max(root(a), root(b))] = min(root(a), root(b))
    nodes = {x for a, b in edges if b is not None and a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5), limit).collect()}
    assert got == {x: root(x) for x in nodes}
    assert components(spark.createDataFrame([], "a string, b string"), limit).count() == 0
    named = components(spark.createDataFrame([("b", "c"), ("a", "c")], "a string, b string"), limit)
    assert {(r["node"], r["root"]) for r in named.collect()} == {("a", "a"), ("b", "a"), ("c", "a")}


@pytest.mark.parametrize("weights", ["unit", "idf"])
@pytest.mark.parametrize("threshold", [0.6, 0.857])
def test_cosine_join_loses_no_pair(spark, weights, threshold):
    texts = corpus(11, 160)
    df = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "i long, t string, e boolean").withColumn("side", F.col("e").cast("byte"))
    sets = postings.word_set_table(df.repartition(3), ["i", "side"], ["t"]).persist()
    rows = [(r["key"], r["side"], set(words(texts[r["i"]]))) for r in sets.collect()]
    counts = postings.document_counts(sets)
    n = sets.count()

    def weight(w):
        h = word_hashes([w])[1]
        return 1.0 if weights == "unit" else float(np.float32(np.log1p(n / max(counts[postings.bucket_of(h)][0], 1))))

    table = {w: weight(w) for w in {w for _, _, s in rows for w in s}}
    norm = lambda s: sum(table[w] ** 2 for w in s) ** 0.5
    wanted = {
        (min(a[0], b[0]), max(a[0], b[0])) for a in rows if a[1] == 0 for b in rows if b[1] == 1
        if sum(table[w] ** 2 for w in a[2] & b[2]) / norm(a[2]) / norm(b[2]) >= threshold + 1e-6
    }
    found = {(r["a"], r["b"]) for r in overlap.cosine_candidates(sets, threshold, weights).collect()}
    assert wanted <= found


def test_cross_split_overlaps(spark):
    rows = [(1, 0, "uno dos tres cuatro"), (2, 1, "uno dos tres cuatro"), (3, 1, "uno dos tres"), (4, 1, "tres dos"), (5, 0, None), (6, 1, ""), (7, 0, "uno dos tres")]
    df = spark.createDataFrame(rows, "i long, side int, t string").withColumn("side", F.col("side").cast("byte"))
    sets = postings.word_set_table(df, ["i", "side"], ["t"]).persist()
    of = {r["key"]: r["n"] for r in sets.collect()}
    assert sorted((of[r["a"]], of[r["b"]], r["common"]) for r in overlap.cross_split_overlaps(sets, 0.75).collect()) in ([(3, 3, 3), (3, 4, 3), (4, 4, 4)], [(3, 3, 3), (4, 3, 3), (4, 4, 4)])
    assert overlap.cross_split_overlaps(sets.filter("false"), 0.75).count() == 0


@pytest.mark.parametrize("weights", ["unit", "idf"])
def test_cosines_are_exact(spark, weights):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.sample(words, rng.randrange(4, 9))) for _ in range(120)]
    rows = [(i, i % 2, t) for i, t in enumerate(texts)]
    sets = postings.word_set_table(spark.createDataFrame(rows, "id long, side int, t string").withColumn("side", F.col("side").cast("byte")), ["id", "side"], ["t"])
    df = {w: sum(w in t.split() for t in texts) for w in words}
    weigh = {w: 1.0 if weights == "unit" else math.log1p(len(texts) / max(df[w], 1)) for w in words}
    norm = lambda t: math.sqrt(sum(weigh[w] ** 2 for w in t.split()))
    key = {r["id"]: r["key"] for r in sets.select("id", "key").collect()}
    want = {}
    for i, _, a in rows:
        for j, _, b in rows:
            if i % 2 == 0 and j % 2 == 1:
                cosine = sum(weigh[w] ** 2 for w in set(a.split()) & set(b.split())) / norm(a) / norm(b)
                if cosine >= 0.55:
                    want[min(key[i], key[j]), max(key[i], key[j])] = cosine
    got = {(r["a"], r["b"]): r["cosine"] for r in overlap.cosine_pairs(sets, 0.55, weights).collect()}
    assert want and got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-4 for p in want)
