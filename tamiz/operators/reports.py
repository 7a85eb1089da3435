"""Reports as small tables of named measures: every one is an aggregate, and none gathers its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


def histograms(rows: DataFrame, columns: dict[str, Column], by: Column | None = None) -> DataFrame:
    """(``measure``, ``key``, ``value``): how many rows have each value of each column, all in one aggregation; arrays count once per
    element. With ``by`` the measure is ``name:by`` for each of its values, and ``name`` over all."""
    parts = []
    for name, c in columns.items():
        one = _named(name)
        parts.append(F.transform(c, one) if _is_array(rows, c) else F.array(one(c)))
    base = rows.select((by if by is not None else F.lit(None).cast("string")).alias("_by"), F.explode(F.concat(*parts)).alias("x"))
    counts = base.groupBy("_by", "x.measure", "x.key").agg(F.count(F.lit(1)).cast("double").alias("value"))
    whole = counts.groupBy("measure", "key").agg(F.sum("value").alias("value"))
    if by is None:
        return whole
    return whole.unionByName(counts.filter("_by is not null").select(F.concat_ws(":", "measure", "_by").alias("measure"), "key", "value"))


def _named(name: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(name).alias("measure"), F.coalesce(x.cast("string"), F.lit("unknown")).alias("key"))


def _is_array(rows: DataFrame, c: Column) -> bool:
    return rows.select(c.alias("x")).schema["x"].dataType.typeName() == "array"


def measures(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(``measure``, ``key``, ``value``): aggregates over all rows by name; the key is ''."""
    one = rows.agg(*[c.cast("double").alias(n) for n, c in values.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.lit("").alias("key"), F.col(f"`{n}`").alias("value")) for n in values])).alias("x")).select("x.*")


def union(parts: Iterable[DataFrame]) -> DataFrame:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def multiset_sum(counts: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Counts of several tables put together; what isn't positive is dropped."""
    return counts.groupBy(*keys).agg(F.sum(n).alias(n)).filter(F.col(n) > 0)


def sorted_map(counts: DataFrame, key: str, n: str) -> Column:
    """An aggregate: the counts of a bounded number of keys as ``{"key": n, ...}``, the keys ascending."""
    pairs = F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(key), F.lit("unknown")).alias("k"), F.col(n).alias("n")))), lambda x: F.concat(F.to_json(F.struct(x.k.alias("k"))), F.lit("|"), x.n))
    text = F.transform(pairs, lambda p: F.concat(F.regexp_extract(p, r'^\{"k":(".*")\}\|', 1), F.lit(": "), F.regexp_extract(p, r"\|(\d+)$", 1)))
    return F.concat(F.lit("{"), F.array_join(text, ", "), F.lit("}"))


def build_report(chunks: DataFrame, reason: Column, split: Column, document: str) -> DataFrame:
    """What a build made of chunk candidates: how many were accepted, why not, and of the accepted the records, documents and shares of
    each split, their mean tokens and their distributions by split. Documents in several splits are leaks."""
    rows = chunks.withColumn("_reason", reason).withColumn("_split", split)
    accepted = rows.filter("_reason = ''")
    per = accepted.filter("_split is not null").groupBy("_split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(document).alias("d"))
    shares = per.crossJoin(F.broadcast(per.agg(F.sum("n").alias("_all")))).select(F.explode(F.array(
        F.struct(F.lit("records").alias("measure"), F.col("_split").alias("key"), F.col("n").cast("double").alias("value")),
        F.struct(F.lit("documents").alias("measure"), F.col("_split").alias("key"), F.col("d").cast("double").alias("value")),
        F.struct(F.lit("ratio").alias("measure"), F.col("_split").alias("key"), F.round(F.col("n") / F.col("_all"), 4).alias("value")),
    )).alias("x")).select("x.*")
    leaks = accepted.filter("_split is not null").groupBy(document).agg(F.countDistinct("_split").alias("s"))
    return union((
        measures(rows, {"candidates": F.count(F.lit(1)), "accepted": F.count_if(F.col("_reason") == ""), "mean_tokens": F.round(F.avg(F.when(F.col("_reason") == "", F.col("token_estimate"))), 2)}),
        histograms(rows.filter("_reason <> ''"), {"rejected": F.col("_reason")}), shares,
        measures(leaks, {"leakage_documents": F.count_if(F.col("s") > 1)}),
        histograms(accepted, {"document": F.col(document), "topic": F.coalesce("topics", F.array().cast("array<string>")), "role": F.col("content_role"), "doc_type": F.col("doc_type"), "language": F.col("language")}, F.col("_split")),
    ))


def audit_report(pages: DataFrame, chunks: DataFrame, records: DataFrame, inventory: DataFrame, split: Column, document: str) -> DataFrame:
    """Pages, chunks, records by split, documents by split and in several, topics by split, and the inventory's histograms. ``records``
    have ``topics`` and ``language``."""
    rows = records.withColumn("_split", split).filter("_split is not null")
    per = rows.groupBy(document).agg(F.collect_set("_split").alias("s"))
    inside = measures(per, {**{f"documents:{s}": F.count_if(F.array_contains("s", s)) for s in SPLITS}, "overlapping_documents": F.count_if(F.size("s") > 1)})
    excluded = inventory.filter(F.col("inclusion_status") == "excluded_with_reason")
    return union((
        measures(pages, {"pages": F.count(F.lit(1)), "documents_with_pages": F.countDistinct("source")}),
        measures(inventory.select(F.explode("page_ocr_status").alias("p")), {"pages_needing_ocr": F.count_if("p.needs_ocr")}),
        measures(chunks, {"chunks": F.count(F.lit(1)), "mean_tokens": F.round(F.avg(F.coalesce("token_estimate", F.lit(0))), 2)}),
        measures(rows, {f"records:{s}": F.count_if(F.col("_split") == s) for s in SPLITS}), inside, histograms(chunks, {"chunks_of": F.col("source_pdf")}),
        histograms(rows, {"topic": F.coalesce("topics", F.array().cast("array<string>")), "language": F.col("language")}, F.col("_split")),
        histograms(inventory, {"doc_type": F.col("doc_type"), "inclusion": F.col("inclusion_status"), "ocr": F.col("ocr_status.status")}),
        histograms(excluded, {"exclusion": F.col("exclusion_reason")}),
    ))


def source_balance(rows: DataFrame, split: Column, source: str = "source_pdf", kind: str = "doc_type") -> DataFrame:
    """(``measure``, ``key``, ``value``): rows by source and by kind of document, in each split and over all."""
    return histograms(rows, {"source": F.col(source), "kind": F.col(kind)}, split)


def table_report(tables: DataFrame, documents: DataFrame, document: str, page: str, strategy: str) -> tuple[DataFrame, DataFrame]:
    """Per document (``tables``, ``pages_with_tables``, ``by_lines``, ``by_text``), documents without any included, and the global sums."""
    per = tables.groupBy(document).agg(
        F.count(F.lit(1)).alias("tables"), F.countDistinct(page).alias("pages_with_tables"), F.count_if(F.col(strategy) == "lines").alias("by_lines"),
        F.count_if(F.col(strategy) == "text").alias("by_text"),
    )
    whole = documents.select(document).distinct().join(per, document, "left").fillna(0, ["tables", "pages_with_tables", "by_lines", "by_text"])
    total = measures(whole, {
        "documents": F.count(F.lit(1)), "documents_with_tables": F.count_if(F.col("tables") > 0), "tables": F.sum("tables"), "by_lines": F.sum("by_lines"), "by_text": F.sum("by_text"),
    })
    return whole, total


def generation_rollup(per_chunk: DataFrame, quality: DataFrame, verdict: str, scores: Sequence[str]) -> DataFrame:
    """The grounding and quality of a generation run. Chunk means (rounded to four digits, as each chunk reports its own) are weighted by their
    pairs; ``per_chunk`` has ``pairs``, ``overlap`` and ``low``."""
    n = F.greatest(F.lit(1), F.sum("pairs"))
    low = {"overlap": F.round(F.sum(F.round("overlap", 4) * F.col("pairs")) / n, 4), "low_pairs": F.sum("low"), "pairs": F.sum("pairs"), "low_rate": F.round(F.sum("low") / n, 4)}
    rated = quality.filter(F.col(scores[0]).isNotNull())
    good = {"evaluated": F.count(F.lit(1)), "acceptance": F.round(F.avg((F.coalesce(F.col(verdict), F.lit("")) == "accept").cast("double")), 4)}
    return measures(per_chunk, low).unionByName(measures(rated, good | {f"mean_{c}": F.round(F.avg(c), 4) for c in scores}))


def predictions_summary(rows: DataFrame, scores: Sequence[str], error: str) -> DataFrame:
    """How many predictions were evaluated and failed, and the mean of each score over those that have it, rounded to four digits."""
    own = {"evaluated": F.count(F.lit(1)), "with_error": F.count_if(F.coalesce(F.col(error), F.lit("")) != "")}
    return measures(rows, own | {f"mean_{c}": F.round(F.avg(c), 4) for c in scores})


def variant_check(variants: dict[str, DataFrame], by: str) -> DataFrame:
    """(``by``, a count for each variant, ``equal``): whether the variants of a publication hold equally many rows in each part."""
    counted = union(v.select(F.col(by), F.lit(n).alias("_v")) for n, v in variants.items())
    out = counted.groupBy(by).agg(*[F.count_if(F.col("_v") == n).alias(n) for n in variants])
    names = list(variants)
    equal = F.lit(True)
    for n in names[1:]:
        equal = equal & (F.col(n) == F.col(names[0]))
    return out.withColumn("equal", equal)


def meta_reference_counts(rows: DataFrame, answer: str, patterns: Sequence[str]) -> DataFrame:
    """(``pattern``, ``n``): how many answers each pattern of speaking about one's source is found in."""
    low = F.lower(F.coalesce(F.col(answer), F.lit("")))
    one = rows.agg(*[F.count_if(low.rlike(p)).alias(f"n{i}") for i, p in enumerate(patterns)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(i).alias("pattern"), F.col(f"n{i}").alias("n")) for i in range(len(patterns))])).alias("x")).select("x.*")
