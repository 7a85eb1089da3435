"""Documents that are the same or nearly so, by their fingerprints (the first hundred longer words of a sample)."""

from __future__ import annotations

import math
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions import text as tx
from tamiz.operators.alike import alike
from tamiz.plans.durable import durable


def fingerprints(documents: DataFrame, document: str, sample: str) -> DataFrame:
    """(``id``, ``fingerprint``) of the documents with an id and a sample."""
    rows = documents.filter((F.coalesce(F.col(document), F.lit("")) != "") & (F.coalesce(F.col(sample), F.lit("")) != ""))
    return rows.select(F.col(document).alias("id"), tx.fingerprint(sample).alias("fingerprint"))


def equal_documents(prints: DataFrame) -> DataFrame:
    """(``id``, ``first``): every document whose fingerprint another one has, and the least of these; copies aren't paired with each other."""
    first = prints.groupBy(F.sha2("fingerprint", 256).alias("_k")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return prints.select("id", F.sha2("fingerprint", 256).alias("_k")).join(first, "_k").select("id", "first")


#: Texts and characters of a group; each two groups that can hold a pair are compared in one task.
GROUP_TEXTS, GROUP_CHARS = 4096, 4 << 20


def near_documents(prints: DataFrame, threshold: float = 0.85, group: int = GROUP_TEXTS) -> DataFrame:
    """(``id_a``, ``id_b``, ``similarity``): all pairs, ``id_a`` < ``id_b``, whose fingerprints are alike by ``threshold`` in the ratio of
    matching blocks of characters (over 200 characters it leaves frequent characters out, so that little but equal fingerprints is alike).

    Equal fingerprints stand for one another: the least id of each is compared. Fingerprints are put into classes by length so that
    pairs of the wanted ratio lie in the same or neighbouring classes, and classes into groups of about ``group`` texts by hash. Each two
    groups meet in one task, where bounds rule most pairs out (``alike``); none is lost, and the others' ratios are computed exactly.
    """
    one = prints.groupBy("fingerprint").agg(F.min("id").alias("id")).filter("fingerprint <> ''")
    # A ratio of t is at most 2 min / (min + max) of the lengths: the longer one has up to (2 - t) / t times the characters.
    step = max(math.log((2 - threshold) / max(threshold, 1e-9)), 0.1) + 1e-9
    one = durable(one.withColumn("class", F.floor(F.log(F.length("fingerprint").cast("double")) / F.lit(step)).cast("int")))
    sizes = {r["class"]: (r["n"], r["chars"]) for r in one.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("fingerprint")).alias("chars")).collect()}
    groups = {c: math.ceil(max(n / group, chars / GROUP_CHARS)) for c, (n, chars) in sorted(sizes.items())}
    begin = dict(zip(groups, accumulate(groups.values(), initial=0), strict=False))
    # The groups of a text's class, and those that it meets: its own class's and the neighbours'. A row for each of some 200 classes at most.
    rows = [(c, begin[c], g, min(begin.get(c - 1, begin[c]), begin[c]), begin.get(c + 1, begin[c]) + groups.get(c + 1, g) - 1) for c, g in groups.items()]
    classes = prints.sparkSession.createDataFrame(rows, "class int, begin int, groups int, lo int, hi int")
    own = (F.col("begin") + F.pmod(F.xxhash64("id"), F.col("groups"))).cast("int")
    placed = one.join(F.broadcast(classes), "class").select("id", "fingerprint", own.alias("own"), F.explode(F.sequence("lo", "hi")).alias("other"))
    met = placed.select("id", "fingerprint", "own", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"))
    tasks = min(4096, max(1, sum(r[2] * (r[4] - r[3] + 1) for r in rows)))

    def pairs(table: pa.Table) -> pa.Table:
        left = pc.equal(table["own"], table["left"])
        sides = [(t["id"].to_pylist(), t["fingerprint"].to_pylist()) for t in (table.filter(left), table.filter(pc.invert(left)))]
        same = table["left"][0].as_py() == table["right"][0].as_py()
        found = alike(*sides[0], None if same else sides[1], threshold) if same or all(x for x, _ in sides) else []
        return pa.table([pa.array(x, t) for x, t in zip(zip(*found, strict=True) if found else ([], [], []), _PAIR.types, strict=True)], schema=_PAIR)

    found = met.repartition(tasks, "left", "right").groupBy("left", "right").applyInArrow(pairs, "id_a string, id_b string, similarity double")
    return found.withColumn("similarity", F.round("similarity", 4))


_PAIR = pa.schema([("id_a", pa.string()), ("id_b", pa.string()), ("similarity", pa.float64())])


def duplicate_documents(documents: DataFrame, document: str, sample: str, threshold: float = 0.85) -> DataFrame:
    """(``id``, ``duplicate_of``, ``similarity``): a row for each link of a document to an earlier one (by id), exact copies to the least of
    them; the documents in ``id`` are those that a collection without duplicates leaves out."""
    prints = durable(fingerprints(documents, document, sample))
    exact = equal_documents(prints).filter("id <> first").select("id", F.col("first").alias("duplicate_of"), F.lit(1.0).alias("similarity"))
    near = near_documents(prints, threshold).select(F.col("id_b").alias("id"), F.col("id_a").alias("duplicate_of"), "similarity")
    return exact.unionByName(near)
