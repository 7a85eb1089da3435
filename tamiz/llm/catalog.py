"""The queries of problems 1 to 9 with their production parameters, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import bpe, capping, fuzzy, overlap, packing, pairs, postings, ranking, spam, splits
from tamiz.llm.common import records, source_of, split_of, table
from tamiz.plans import oracle
from tamiz.plans.durable import durable

#: Production parameters.
CAP_SHARE, P3_OVERLAP, P6_OVERLAP, TOP_SHARE, P3_COSINE, P8_CHARACTERS = 0.02, 0.75, 0.70, 0.01, 0.8, 8192
SCORES = {"faithfulness": 1.0, "answer_relevancy": 1.0, "roundtrip_consistency": 1.0, "clinical_score": 1.0}


def _capped(spark: SparkSession, d: str) -> DataFrame:
    return records(table(spark, d, "raw"), chunk_id=F.col("chunk_id"), score=F.col("clinical_score"), section_type=F.col("section_type"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = records(table(spark, d, "raw"), chunk_id=F.col("chunk_id"), score=F.col("clinical_score"))
    return capping.over_cap(rows, "qa_id", source_of(), F.col("score"), share=CAP_SHARE).select(F.col("id").alias("qa_id"))


def p1_capped(spark: SparkSession, d: str) -> DataFrame:
    """Every record with whether it is kept, when each source's cap is split evenly over its section types."""
    out = capping.cap_contributors(
        _capped(spark, d), "qa_id", source_of(), F.col("score"), share=CAP_SHARE, stratum=F.col("section_type"), weights="equal"
    )
    return out.select(F.col("id").alias("qa_id"), F.col("contributor").alias("pdf_id"), F.col("stratum").alias("section_type"), "kept")


def _source_and_split(spark: SparkSession, d: str) -> DataFrame:
    return records(table(spark, d, "raw"), pdf_id=source_of(), chunk_id=F.col("chunk_id"), split=split_of())


def _entity_keys() -> list:
    """Records of a source belong together, and records of a chunk; links lead from each chunk to its source."""
    return [F.col("pdf_id"), F.col("chunk_id")]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    torn = splits.torn_entities(_source_and_split(spark, d), "qa_id", _entity_keys(), F.col("split"))
    return torn.filter(F.col("entity").startswith("0:")).select(F.expr("substring(entity, 3)").alias("pdf_id"))


def p2_assigned(spark: SparkSession, d: str) -> DataFrame:
    """The new split of every record."""
    ratios = {r["split"]: r["ratio"] for r in table(spark, d, "split_targets").orderBy(F.col("ratio").desc(), "split").collect()}
    out = splits.assign_splits(_source_and_split(spark, d), "qa_id", _entity_keys(), ratios)
    return out.select(F.col("id").alias("qa_id"), F.expr("substring(entity, instr(entity, ':') + 1)").alias("pdf_id"), "new_split")


def _sides(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw").select("qa_id", "row_no", "chunk_id", "pregunta", split_of().alias("_split"))
    rows = raw.filter(F.col("_split").isNotNull() & F.col("qa_id").isNotNull() & F.col("pregunta").isNotNull())
    rows = rows.withColumn("side", F.when(F.col("_split") == "train", 0).otherwise(1).cast("byte"))
    return durable(postings.word_set_table(rows, ["qa_id", "row_no", "side"], ["pregunta"]))


def _cross_pairs(sets: DataFrame) -> DataFrame:
    """(``train``, ``other``, ``common``, ``na``, ``nb``): overlapping records, one of each side."""
    found = durable(overlap.cross_split_overlaps(sets, P3_OVERLAP))
    ids = sets.groupBy("qa_id").agg(F.min_by(F.struct("key", "side"), "row_no").alias("m")).select("qa_id", "m.key", "m.side")
    ids = durable(ids.join(found.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi"))
    both = found.union(found.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "common", F.col("nb").alias("na"), F.col("na").alias("nb"), "cosine"))
    train = ids.filter("side = 0").select(F.col("key").alias("a"), F.col("qa_id").alias("train"))
    other = ids.filter("side = 1").select(F.col("key").alias("b"), F.col("qa_id").alias("other"))
    return both.join(train, "a").join(other, "b").select("train", "other", "common", "na", "nb")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    found = _cross_pairs(_sides(spark, d))
    return found.select(F.least("train", "other").alias("qa_id_a"), F.greatest("train", "other").alias("qa_id_b"))


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    """The number of overlapping pairs, and of held-out records in one, by split and source of the held-out record. Copies
    are counted by text before texts meet, so that no pair of records is built."""
    sets = _sides(spark, d)
    found = durable(overlap.cross_split_overlaps(sets, P3_OVERLAP).select("a", "b"))
    ids = sets.groupBy("qa_id").agg(F.min_by(F.struct("key", "side"), "row_no").alias("m")).select("qa_id", "m.key", "m.side")
    of = records(table(spark, d, "raw"), pdf_id=source_of(), split=split_of())
    train = ids.filter("side = 0").groupBy(F.col("key").alias("a")).agg(F.count(F.lit(1)).alias("copies"))
    other = ids.filter("side = 1").join(of, "qa_id").groupBy(F.col("key").alias("b"), "split", "pdf_id").agg(F.count(F.lit(1)).alias("records"))
    both = found.union(found.filter("a <> b").select("b", "a"))
    per = both.join(train, "a").groupBy("b").agg(F.sum("copies").alias("copies"))
    return other.join(per, "b").groupBy("split", "pdf_id").agg(F.sum(F.col("copies") * F.col("records")).alias("pairs"), F.sum("records").alias("records"))


def p3_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Held-out records whose question has a training question of weighted cosine (rare words weigh more) of at least 0.8: how
    many different such questions, and the greatest cosine."""
    sets = _sides(spark, d)
    found = durable(overlap.cosine_pairs(sets, P3_COSINE))
    ids = sets.groupBy("qa_id").agg(F.min_by(F.struct("key", "side"), "row_no").alias("m")).select("qa_id", "m.key", "m.side")
    train = ids.filter("side = 0").select(F.col("key").alias("a")).distinct()
    both = found.union(found.filter("a <> b").select("b", "a", "cosine"))
    per = both.join(train, "a").groupBy("b").agg(F.count(F.lit(1)).alias("links"), F.round(F.max("cosine"), 4).alias("cosine"))
    return ids.filter("side = 1").join(per, F.col("key") == F.col("b")).select("qa_id", "links", "cosine")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw").filter(F.col("qa_id").isNotNull())
    each = pairs.defects(raw, ["qa_id", "row_no"], "pregunta", "respuesta", "contexto_fuente")
    of = each.groupBy("qa_id").agg(F.min_by(F.struct("defect"), "row_no").alias("d")).select("qa_id", "d.defect")
    return of.filter(F.col("defect").isNotNull())


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = records(table(spark, d, "raw"), **{c: F.col(c) for c in SCORES})
    return durable(ranking.combined_scores(rows, "qa_id", SCORES))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return ranking.best(_scored(spark, d), TOP_SHARE).select(F.col("id").alias("qa_id"))


def p5_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Every record with all scores, and its place in the combined ranking."""
    return ranking.best(_scored(spark, d)).select(F.col("id").alias("qa_id"), "rank")


def _near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw").filter(F.col("qa_id").isNotNull())
    sets = postings.word_set_table(raw, ["qa_id", "row_no"], ["contexto_fuente", "respuesta"])
    return fuzzy.near_duplicate_groups(sets, "qa_id", "row_no", P6_OVERLAP)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    groups = durable(_near_duplicates(spark, d))
    return fuzzy.pairs_of(groups).select(F.col("a").alias("qa_id_a"), F.col("b").alias("qa_id_b"))


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per record in a group: its group (named by the least record) and the number of texts linked to its text."""
    groups = durable(_near_duplicates(spark, d))
    names = groups.groupBy("group_key").agg(F.min("id").alias("group_id"))
    return groups.join(names, "group_key").select(F.col("id").alias("qa_id"), "group_id", "links")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose ids don't decode to their text: none."""
    documents = table(spark, d, "documents").select("doc_id", "text")
    back = bpe.decode_ids(bpe.encode_texts(documents, "doc_id", "text"), "doc_id", "ids").withColumnRenamed("text", "decoded")
    return documents.join(back, "doc_id").filter(F.col("decoded") != F.coalesce("text", F.lit(""))).select("doc_id")


def _containers(spark: SparkSession, d: str, capacities: tuple[int, ...]) -> DataFrame:
    sizes = bpe.token_counts(table(spark, d, "documents"), "doc_id", "text")
    return packing.fill_containers(sizes, "doc_id", "n", capacities)


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return _containers(spark, d, (2048,)).drop("capacity")


def p8_lengths(spark: SparkSession, d: str) -> DataFrame:
    """The same with three permitted sequence lengths."""
    return _containers(spark, d, (512, 1024, 2048))


def p8_by_length(spark: SparkSession, d: str) -> DataFrame:
    """Containers of 8,192 characters: of each document its length, its pieces and what of it was placed, and whether every container
    keeps its capacity and all of them together need at most a twentieth more than the least number possible."""
    sizes = table(spark, d, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    out = durable(packing.fill_containers(sizes, "doc_id", "n", (P8_CHARACTERS,)))
    per = out.groupBy("container_id").agg(F.sum(F.col("item_end") - F.col("item_start")).alias("load"))
    least = F.ceil(F.sum("load") / P8_CHARACTERS)
    whole = per.agg((F.max("load") <= P8_CHARACTERS).alias("fits"), (F.count(F.lit(1)) <= 1.05 * least + 1).alias("tight"))
    of = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.col("item_end") - F.col("item_start")).alias("placed"))
    return sizes.join(of, "doc_id", "left").crossJoin(F.broadcast(whole)).select("doc_id", F.col("n").cast("long").alias("n"), "pieces", "placed", "fits", "tight")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(table(spark, d, "documents"), "doc_id", "text", "lang").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n[0] == "p" and n[1].isdigit() and callable(f)}


_RECORDS = """records AS (
  SELECT qa_id, arg_min(chunk_id, row_no) AS chunk_id, regexp_extract(arg_min(chunk_id, row_no), '^(.*)_[0-9]+$', 1) AS pdf_id,
         arg_min(clinical_score, row_no) FILTER (clinical_score IS NOT NULL) AS clinical_score
  FROM raw WHERE qa_id IS NOT NULL GROUP BY qa_id)"""
_SPLIT = """CASE WHEN lower(trim(split)) IN ('train', 'training') THEN 'train'
  WHEN lower(trim(split)) IN ('validation', 'valid', 'val', 'dev') THEN 'validation'
  WHEN lower(trim(split)) IN ('test', 'testing') THEN 'test' END"""
_COMBINED = """r AS (
  SELECT DISTINCT qa_id, faithfulness AS a, answer_relevancy AS b, roundtrip_consistency AS c, clinical_score::double AS d FROM raw
  WHERE qa_id IS NOT NULL AND faithfulness IS NOT NULL AND answer_relevancy IS NOT NULL AND roundtrip_consistency IS NOT NULL
    AND clinical_score IS NOT NULL),
m AS (SELECT median(a) AS a, median(b) AS b, median(c) AS c, median(d) AS d FROM r),
s AS (SELECT 1.4826 * median(abs(r.a - m.a)) AS a, 1.4826 * median(abs(r.b - m.b)) AS b, 1.4826 * median(abs(r.c - m.c)) AS c,
             1.4826 * median(abs(r.d - m.d)) AS d FROM r, m),
o AS (SELECT qa_id, row_number() OVER (ORDER BY
        -(ln(1 + exp(-greatest(least((r.a - m.a) / s.a, 30), -30))) + ln(1 + exp(-greatest(least((r.b - m.b) / s.b, 30), -30)))
        + ln(1 + exp(-greatest(least((r.c - m.c) / s.c, 30), -30))) + ln(1 + exp(-greatest(least((r.d - m.d) / s.d, 30), -30)))) DESC, qa_id) AS rank
      FROM r, m, s)"""


_PAIRS = f"""q AS (
  SELECT qa_id, any_value({_SPLIT}) AS split, any_value(pregunta) AS pregunta, any_value(regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1)) AS pdf_id
  FROM raw WHERE qa_id IS NOT NULL GROUP BY qa_id),
w AS (SELECT qa_id, split = 'train' AS train, list_distinct([x FOR x IN regexp_split_to_array(
        lower(strip_accents(pregunta)), '[^a-z0-9]+') IF x <> '']) AS words FROM q WHERE split IS NOT NULL AND pregunta IS NOT NULL),
e AS (SELECT qa_id, train, len(words) AS n, unnest(words) AS word FROM w),
j AS (SELECT a.qa_id AS x, b.qa_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common
      FROM e a JOIN e b ON a.word = b.word AND a.train AND NOT b.train GROUP BY 1, 2),
p AS (SELECT x, y FROM j WHERE common >= 0.75 * (nx + ny - common))"""
#: Largest remainder in words: every source over its cap is filled stratum by stratum, the smallest first, each with an equal
#: share of what is left; the fractions go to the largest, slots rounded down.
_EQUAL_SLOTS = """n AS (SELECT pdf_id, coalesce(section_type, '') AS section_type, count(*) AS n FROM k WHERE pdf_id IS NOT NULL GROUP BY ALL),
o AS (SELECT * FROM n WHERE pdf_id IN (SELECT pdf_id FROM n GROUP BY 1 HAVING sum(n) > (SELECT cap FROM c))),
l AS (SELECT *, (SELECT cap FROM c) AS cap, list({'n': n, 's': section_type}) OVER (PARTITION BY pdf_id) AS every FROM o),
h AS (SELECT *, list_max([x.n FOR x IN every]) AS most,
  list_max([(cap - list_sum([z.n FOR z IN every IF z.n < y.n] || [0]))::double / len([z FOR z IN every IF z.n >= y.n]) FOR y IN every
            IF y.n > (cap - list_sum([z.n FOR z IN every IF z.n < y.n] || [0]))::double / len([z FOR z IN every IF z.n >= y.n])]) AS level FROM l),
f AS (SELECT *, least(n, level) AS share, floor(least(n, level) + 1e-9) AS whole FROM h),
g AS (SELECT *, cap - sum(whole) OVER (PARTITION BY pdf_id) AS spare,
  row_number() OVER (PARTITION BY pdf_id, whole < n ORDER BY share - whole DESC, n DESC, section_type) AS place FROM f),
slots AS (SELECT pdf_id, section_type, whole + (whole < n AND place <= spare)::int AS slots FROM g)"""


def oracle_sql() -> dict[str, str]:
    words = oracle.norm("concat_ws(' ', contexto_fuente, respuesta)")
    return {
        "p1_found": f"""WITH {_RECORDS}, k AS (
  SELECT qa_id, row_number() OVER (PARTITION BY pdf_id ORDER BY clinical_score DESC NULLS LAST, qa_id) AS place FROM records)
SELECT qa_id FROM k WHERE place > (SELECT floor(0.02 * count(*)) FROM records)""",
        "p1_capped": f"""WITH k AS (SELECT qa_id, nullif(regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1), '') AS pdf_id, section_type, clinical_score FROM raw
  WHERE qa_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY row_no) = 1), c AS (SELECT floor(0.02 * count(*))::bigint AS cap FROM k),
{_EQUAL_SLOTS},
r AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, coalesce(section_type, '') ORDER BY clinical_score DESC NULLS LAST, qa_id) AS place FROM k)
SELECT qa_id, r.pdf_id, coalesce(r.section_type, '') AS section_type, slots IS NULL OR place <= slots AS kept
FROM r LEFT JOIN slots s ON s.pdf_id = r.pdf_id AND s.section_type = coalesce(r.section_type, '')""",
        "p2_found": f"""SELECT regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1) AS pdf_id FROM raw
WHERE {_SPLIT} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_SPLIT}) > 1""",
        "p2_assigned": f"""WITH RECURSIVE {_RECORDS}, t AS (SELECT split, ratio / sum(ratio) OVER () AS ratio, row_number() OVER (ORDER BY ratio DESC, split) AS i FROM split_targets),
z AS (SELECT pdf_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, pdf_id) AS i FROM records GROUP BY 1),
g AS (SELECT 0::bigint AS i, (SELECT list((SELECT count(*) FROM records) * ratio ORDER BY i) FROM t) AS room, 0 AS to_
  UNION ALL SELECT z.i, list_transform(room, lambda x, k: x - CASE WHEN k = list_position(room, list_max(room)) THEN z.n ELSE 0 END), list_position(room, list_max(room))
  FROM g JOIN z ON z.i = g.i + 1),
y AS (SELECT n, to_, count(*) AS c FROM g JOIN z USING (i) GROUP BY 1, 2),
u AS (SELECT n, to_, sum(c) OVER (PARTITION BY n ORDER BY to_) AS upto FROM y),
a AS (SELECT pdf_id, n, row_number() OVER (PARTITION BY n ORDER BY pdf_id) AS place FROM z),
b AS (SELECT pdf_id, min(to_) AS to_ FROM a JOIN u ON u.n = a.n AND place <= upto GROUP BY 1)
SELECT qa_id, pdf_id, split AS new_split FROM records JOIN b USING (pdf_id) JOIN t ON t.i = b.to_""",
        "p3_found": f"WITH {_PAIRS} SELECT least(x, y) AS qa_id_a, greatest(x, y) AS qa_id_b FROM p",
        "p3_counts": f"WITH {_PAIRS} SELECT split, pdf_id, count(*) AS pairs, count(DISTINCT y) AS records FROM p JOIN q ON q.qa_id = y GROUP BY 1, 2",
        "p5_found": f"WITH {_COMBINED} SELECT qa_id FROM o WHERE rank <= (SELECT floor(count(*) / 100.0) FROM r)",
        "p8_by_length": f"""SELECT doc_id, length(coalesce(text, ''))::bigint AS n, greatest(1, ceil(length(coalesce(text, '')) / {P8_CHARACTERS}.0::double))::bigint AS pieces,
  length(coalesce(text, ''))::bigint AS placed, true AS fits, true AS tight FROM documents""",
        "p5_ranking": f"WITH {_COMBINED} SELECT qa_id, rank FROM o",
        "p6_found": f"""WITH RECURSIVE q AS (SELECT qa_id, contexto_fuente, respuesta FROM raw WHERE qa_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY row_no) = 1),
v AS MATERIALIZED (SELECT qa_id, list_distinct([x FOR x IN string_split({words}, ' ') IF x <> '']) AS words FROM q),
e AS MATERIALIZED (SELECT qa_id, len(words) AS n, unnest(words) AS word FROM v),
j AS (SELECT a.qa_id AS x, b.qa_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common FROM e a JOIN e b ON a.word = b.word AND a.qa_id < b.qa_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM j WHERE common >= 0.70 * (nx + ny - common)),
s AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT DISTINCT x AS a, x AS b FROM s UNION SELECT r.a, s.y FROM r JOIN s ON s.x = r.b)
SELECT a AS qa_id_a, b AS qa_id_b FROM r WHERE a < b""",
    }
