"""Pages of text: metrics, repeated lines, sections and the rules by which pages are dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.operators.ordered import carried_forward
from tamiz.plans.durable import once


def with_metrics(pages: DataFrame, text: str) -> DataFrame:
    """``pages`` with ``cleaned`` and the metrics of the cleaned text, each made once."""
    out = once(pages, cleaned=tx.clean(text))
    out = once(out, _norm=tx.normalize("cleaned"), word_count=tx.word_count("cleaned"), reference_line_ratio=tx.reference_ratio("cleaned"))
    return once(
        out, char_count=F.length("cleaned"), line_count=F.size(tx.nonblank_lines("cleaned")),
        clinical_score=tx.clinical_score(F.col("_norm"), F.col("word_count"), F.col("reference_line_ratio")),
        suspicious_char_ratio=tx.suspicious_ratio("cleaned"), reference_marker_count=tx.reference_markers("cleaned"),
    ).drop("_norm")


def drop_reason(page: Column) -> Column:
    """Why a page with metrics, ``_lines`` and ``_start`` is dropped, '' if it is kept; the first rule that holds counts, and null metrics hold none."""
    lines, start = F.col("_lines"), F.col("_start")
    score = F.col("clinical_score")
    leaders = F.size(F.filter(lines, lambda x: x.rlike(r"\.{3,}\s*[0-9]+$")))
    short = F.size(F.filter(lines, lambda x: F.length(x) <= 28))
    first = F.exists(F.slice(lines, 1, 15), lambda x: tx.normalize(x).isin(*lx.DROP_HEADINGS))
    return tx.cascade([
        ("too_short", (F.col("char_count") < 180) | (F.col("word_count") < 25)),
        ("corrupt_extraction", F.col("suspicious_char_ratio") >= 0.018),
        ("cover_or_credits", (page <= 2) & tx.any_of(start, ("isbn", "copyright", "editorial")) & (score < 3)),
        ("non_clinical_section", first),
        ("index_or_table_of_contents", tx.any_of(F.substring(start, 1, 800), lx.INDEX_TERMS) & ((leaders >= 3) | (score < 4))),
        ("non_clinical_section", start.rlike("^(" + "|".join(lx.DROP_HEADINGS) + ")")),
        ("reference_heavy", (F.col("reference_line_ratio") >= 0.45) & (score < 6)),
        ("reference_heavy", (F.col("reference_marker_count") >= 5) & (score < 10)),
        ("fragmented_text", (F.col("line_count") >= 12) & (short >= F.col("line_count") * F.lit(0.72)) & (score < 5)),
    ])


def classify_pages(pages: DataFrame, text: str, page: str, needs_ocr: str | None = None) -> DataFrame:
    """``pages`` with metrics, ``drop_reason`` and ``is_kept``; a short page that needs OCR is dropped for that."""
    out = once(with_metrics(pages, text), _lines=tx.nonblank_lines("cleaned"), _start=tx.normalize(F.substring("cleaned", 1, 2500)))
    reason = drop_reason(F.col(page))
    if needs_ocr:
        reason = F.when(F.coalesce(F.col(needs_ocr), F.lit(False)) & (F.col("char_count") < 180), "needs_ocr").otherwise(reason)
    return once(out, drop_reason=reason).withColumn("is_kept", F.col("drop_reason") == "").drop("_lines", "_start")


def repeated_lines(pages: DataFrame, source: str, page: str, text: str, ratio: float = 0.28) -> DataFrame:
    """(source, ``signature``, ``line``, ``pages``): lines that stand on at least three pages and ``ratio`` of a source's pages.

    Lines over 120 characters and signatures too short don't count; ``line`` is the spelling of the first page. A page
    gives each signature once, so no page's repetition is shuffled. Pages without a source belong to none.
    """
    rows = pages.filter(F.col(source).isNotNull()).select(F.col(source).alias("_source"), F.col(page).alias("_page"), F.col(text).alias("_text"))
    each = F.filter(F.transform(tx.lines_of("_text"), tx.strip), lambda x: F.length(x) <= 120)
    lines = rows.select("_source", "_page", F.posexplode(each).alias("_at", "line"))
    lines = once(lines, signature=tx.line_signature(F.col("line")))
    seen = lines.filter("signature <> ''").groupBy("_source", "signature").agg(
        F.countDistinct("_page").alias("pages"), F.min_by("line", F.struct("_page", "_at")).alias("line")
    )
    totals = rows.groupBy(F.col("_source").alias("_s")).agg(F.count(F.lit(1)).alias("_total"))
    enough = F.col("pages") >= F.greatest(F.lit(3), F.ceil(F.col("_total") * F.lit(ratio)))
    return seen.join(totals, F.col("_source") == F.col("_s")).filter(enough).select(F.col("_source").alias(source), "signature", "line", "pages")


def without_repeated_lines(pages: DataFrame, source: str, page: str, text: str, ratio: float = 0.28) -> DataFrame:
    """``pages`` with ``text`` freed of its source's repeated lines, and ``removed_lines``.

    A source has at most 1/ratio times as many repeated lines as a page has lines, so they travel as one array.
    """
    lines = repeated_lines(pages, source, page, text, ratio).groupBy(F.col(source).alias("_source")).agg(F.collect_set("signature").alias("_signatures"))
    out = pages.join(lines, F.col(source) == F.col("_source"), "left")
    out = once(out, _lines=tx.lines_of(text))
    kept = F.filter("_lines", lambda x: ~F.coalesce(F.array_contains(F.col("_signatures"), tx.line_signature(x)), F.lit(False)))
    out = once(out, _kept=kept).withColumn("removed_lines", F.size("_lines") - F.size("_kept"))
    joined = tx.strip(F.regexp_replace(F.array_join("_kept", "\n"), r"\n{3,}", "\n\n"))
    return out.withColumn(text, joined).drop("_source", "_signatures", "_lines", "_kept")


def with_sections(pages: DataFrame, source: str, order: Sequence[str], text: str, name: str = "section") -> DataFrame:
    """``pages`` with the last heading at or before each page of its source in ``order`` (which must be total), '' before the first."""
    out = once(pages, _heading=F.nullif(tx.first_heading(text), F.lit("")))
    out = carried_forward(out, [source], [F.col(c).asc() for c in order], "_heading", "_section")
    return out.withColumn(name, F.coalesce("_section", F.lit(""))).drop("_heading", "_section")


def cleaning_report(classified: DataFrame) -> DataFrame:
    """Pages in all, kept, and dropped by reason, in one row each."""
    # One pass: pages are counted by reason, and the few counts are put together.
    per = classified.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("drop_reason") == ""
    row = lambda m, holds: F.when(holds, F.struct(m.alias("measure"), F.col("n").alias("n")))
    rows = F.array_compact(F.array(
        row(F.lit("total_pages"), F.lit(True)), row(F.lit("kept_pages"), kept), row(F.lit("dropped_pages"), ~kept), row(F.concat(F.lit("drop:"), F.col("drop_reason")), ~kept),
    ))
    return per.select(F.explode(rows).alias("x")).groupBy("x.measure").agg(F.sum("x.n").alias("n"))
