"""Operations that depend on an order, spread over tasks whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.plans.durable import durable


def _laid_out(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows range-partitioned over group and order, with the task (``_part``) and place (``_at``) of each."""
    keys = [F.col(g).asc_nulls_first() for g in groups]
    rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return durable(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))


def _by_part(rows: DataFrame, parts: DataFrame, groups: Sequence[str], values: Sequence[str], how: str) -> DataFrame:
    renamed = parts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_part").alias("_q"), *values)
    same = F.col("_part") == F.col("_q")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(renamed, same, how)


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with its 1-based rank within ``groups`` in ``order`` (which must end in a unique column).

    A group may hold any share of the rows: rows are range-partitioned over group *and* order, so a hot group is
    spread over many tasks. Each task numbers its rows; a small table of the rows per task and group gives the offsets.
    """
    rows = _laid_out(df, groups, order)
    parts = rows.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rank = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return _by_part(rows, parts, groups, ["_first", "_before"], "inner").select(*df.columns, rank.alias(name))


def carried_forward(df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``df`` with the last non-null ``value`` at or before each row of its group in ``order`` (which must be total).

    Carried within a task's own rows first; what a task inherits comes from a table of one row per task and group.
    """
    rows = _laid_out(df, groups, order)
    own = Window.partitionBy("_part", *groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.last(value, ignorenulls=True).over(own))
    parts = rows.groupBy(*groups, "_part").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_at"))).alias("_last"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_inherited", F.last("_last", ignorenulls=True).over(before))
    return _by_part(rows, parts, groups, ["_inherited"], "left").select(*df.columns, F.coalesce("_own", "_inherited").alias(name))


def running_total(df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over its group's rows up to and including each, in ``order`` (which must be total); null counts as 0.

    Summed within a task's own rows first; what comes before a task is from a table of one row per task and group.
    """
    rows = _laid_out(df, groups, order)
    own = Window.partitionBy("_part", *groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.sum(F.coalesce(F.col(value), F.lit(0))).over(own))
    parts = rows.groupBy(*groups, "_part").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_earlier", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    return _by_part(rows, parts, groups, ["_earlier"], "inner").select(*df.columns, (F.col("_own") + F.col("_earlier")).alias(name))
