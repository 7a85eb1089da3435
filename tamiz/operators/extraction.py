"""From pages as extractors give them to page rows: the fallback, the need for OCR, the sample of a document's text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import text as tx
from tamiz.operators.ordered import running_total
from tamiz.plans.durable import once


def with_fallback(pages: DataFrame, primary: str, fallback: str, cleaner=tx.clean, least: int = 120, ocr_below: int = 80, names: tuple[str, str] = ("primary", "fallback")) -> DataFrame:
    """``pages`` with ``text``, ``extraction_method``, ``char_count``, ``word_count`` and ``needs_ocr``: the fallback's text where the first
    extractor's, cleaned, is under ``least`` characters and the fallback's is longer; pages under ``ocr_below`` need OCR."""
    out = once(pages, _a=cleaner(primary), _b=F.coalesce(F.col(fallback), F.lit("")))
    other = F.when(F.length("_a") < least, cleaner("_b")).otherwise(F.lit(""))
    out = once(out, _c=other)
    use = (F.length("_a") < least) & (F.length("_c") > F.length("_a"))
    out = once(out, _clean=F.when(use, F.col("_c")).otherwise(F.col("_a")), _use=use)
    return out.select(
        *[c for c in pages.columns if c != "text"], F.when(F.col("_use"), F.col("_b")).otherwise(F.coalesce(F.col(primary), F.lit(""))).alias("text"),
        F.when(F.col("_use"), names[1]).otherwise(names[0]).alias("extraction_method"), F.length("_clean").alias("char_count"), tx.word_count("_clean").alias("word_count"),
        (F.length("_clean") < ocr_below).alias("needs_ocr"),
    )


def document_roll_up(pages: DataFrame, document: str) -> DataFrame:
    """(document, ``page_count``, ``fallback_pages``, ``needs_ocr_pages``, ``chars``) of pages with an extraction method."""
    return pages.groupBy(document).agg(
        F.count(F.lit(1)).alias("page_count"), F.count_if(F.col("extraction_method") == "fallback").alias("fallback_pages"), F.count_if("needs_ocr").alias("needs_ocr_pages"),
        F.sum("char_count").cast("long").alias("chars"),
    )


def text_samples(pages: DataFrame, document: str, order: list[Column], text: Column, least: int = 3000, most: int = 2000) -> DataFrame:
    """(document, ``text_sample``): the first pages with text, until together they have ``least`` characters, joined and cut to ``most``.

    Lengths are summed over range partitions, so a document of any number of pages is spread over tasks; only its first pages,
    at most ``least`` of them, are joined.
    """
    rows = once(pages.select(*pages.columns), _t=F.trim(F.coalesce(text, F.lit("")))).filter("_t <> ''")
    rows = rows.select(document, *[c.alias(f"_o{i}") for i, c in enumerate(order)], F.substring("_t", 1, least).alias("_t"), F.length("_t").alias("_n"))
    keys = [F.col(f"_o{i}").asc() for i in range(len(order))]
    # Joined by one space: before a page stand the pages before it and a space between each two.
    summed = running_total(rows.withColumn("_with", F.col("_n") + 1), [document], keys, "_with", "_upto")
    early = summed.filter(F.col("_upto") - F.col("_with") - 1 < least)
    listed = early.groupBy(document).agg(F.array_sort(F.collect_list(F.struct(*[f"_o{i}" for i in range(len(order))], "_t"))).alias("_l"))
    return listed.select(document, F.substring(F.array_join(F.transform("_l", lambda x: x._t), " "), 1, most).alias("text_sample"))
