"""Grids of cells: normalising, quality, and whether a grid is a table or a fragment of layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import text as tx


def normalized_grid(grid: Column) -> Column:
    """Cells trimmed, nulls empty, rows padded to the widest."""
    cells = F.transform(grid, lambda r: F.transform(r, lambda c: tx.strip(F.coalesce(c, F.lit("")))))
    width = F.coalesce(F.array_max(F.transform(grid, lambda r: F.size(r))), F.lit(0))
    return F.transform(cells, lambda r: F.concat(r, F.array_repeat(F.lit(""), F.greatest(width - F.size(r), F.lit(0)))))


def with_grid_quality(tables: DataFrame, grid: str) -> DataFrame:
    """``tables`` with the metrics of a normalised grid, not rounded, and whether its first row is like a header and it like layout."""
    filled = F.filter(F.flatten(grid), lambda c: c != "")
    words = F.transform("_filled", lambda c: tx.token_count(c))
    share = lambda n, of: F.coalesce(F.try_divide(n.cast("double"), of), F.lit(0.0))
    out = tables.withColumn("_filled", filled).withColumn("_words", words).select(
        "*", F.size(grid).alias("row_count"), F.coalesce(F.size(F.get(grid, F.lit(0))), F.lit(0)).alias("col_count"),
        share(F.size("_filled"), F.size(F.flatten(grid))).alias("non_empty_density"),
        share(F.size(F.filter("_filled", lambda c: c.rlike("[0-9]"))), F.size("_filled")).alias("numeric_ratio"),
        share(F.aggregate("_words", F.lit(0), lambda a, x: a + x), F.size("_words")).alias("avg_words_per_cell"),
        F.coalesce(F.array_max("_words"), F.lit(0)).alias("max_words_cell"),
        share(F.size(F.filter("_filled", lambda c: c.rlike(r"^[\p{L}\p{N}_]{1,3}$"))), F.size("_filled")).alias("short_cell_ratio"),
        share(F.size(F.filter(grid, lambda r: F.forall(r, lambda c: c == ""))), F.size(grid)).alias("empty_row_ratio"),
    )
    first = F.filter(F.get(grid, F.lit(0)), lambda c: c != "")
    header = (F.coalesce(F.size(first), F.lit(0)) >= 2) & F.coalesce(F.forall(first, lambda c: tx.token_count(c) <= 6), F.lit(False))
    n = F.col("numeric_ratio")
    layout = (
        ((F.col("col_count") >= 6) & (F.col("row_count") >= 30) & (n < 0.08)) | ((F.col("avg_words_per_cell") > 8) & (n < 0.1))
        | (F.col("max_words_cell") > 45) | ((F.col("short_cell_ratio") > 0.55) & (n < 0.1)) | (F.col("non_empty_density") < 0.35)
    )
    return out.withColumn("is_header_like", header).withColumn("is_layout", layout).drop("_filled", "_words")


def accepted_tables(tables: DataFrame, grid: str, strategy: str, min_rows: int = 2, min_cols: int = 2, strict: bool = True) -> DataFrame:
    """Tables large enough, filled enough and, if strict, not layout; those found by text need numbers or a terse header too."""
    filled = F.size(F.filter(F.flatten(grid), lambda c: c != ""))
    ok = (F.col("row_count") >= min_rows) & (F.col("col_count") >= min_cols) & (filled >= min_rows * min_cols)
    if strict:
        by_text = (F.col("numeric_ratio") >= 0.18) & ((F.col("numeric_ratio") >= 0.12) | (F.col("is_header_like") & (F.col("avg_words_per_cell") <= 4)))
        ok = ok & ~F.col("is_layout") & ((F.col(strategy) != "text") | by_text)
    return tables.filter(ok)


def first_of_equal(tables: DataFrame, signature: list[Column], order: Column) -> DataFrame:
    """One of the tables with equal signature (page, size, place, headers, first row): the first by ``order``."""
    rows = tables.groupBy(F.xxhash64(*signature).alias("_h"), *[s.alias(f"_s{i}") for i, s in enumerate(signature)])
    return rows.agg(F.min_by(F.struct(*tables.columns), order).alias("_row")).select("_row.*")


def header(grid: str) -> Column:
    """The first row of a grid, null without rows."""
    return F.get(F.col(grid), F.lit(0))


def body(grid: str) -> Column:
    """The rows after the first."""
    return F.slice(F.col(grid), F.lit(2), F.greatest(F.size(grid) - 1, F.lit(0)))
