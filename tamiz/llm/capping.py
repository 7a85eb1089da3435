"""Problem 1: capping the records of each contributor."""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.common import joined, ranked
from tamiz.plans.durable import durable


def quotas(sizes: DataFrame, cap: int, weights: str = "size") -> DataFrame:
    """Slots of each (``contributor``, ``stratum``) with ``n`` records, for contributors of more than ``cap`` records.

    ``weights='size'`` gives each stratum its proportional share of the cap, ``'equal'`` the same number; in both, the
    fractions are settled by largest remainder (ties: larger stratum, then name) and slots that a small stratum can't
    use go to the others, level by level. The slots of a contributor add up to ``cap``.
    """
    own = Window.partitionBy("contributor")
    sizes = sizes.withColumn("_all", F.sum("n").over(own)).filter(F.col("_all") > cap)
    if weights == "size":
        share = F.col("n") * F.lit(cap) / F.col("_all")
    elif weights == "equal":
        # Strata in ascending size: one is full if its size is no more than the level of those still open.
        asc = own.orderBy("n", F.col("stratum").asc_nulls_first())
        sizes = (
            sizes.withColumn("_k", F.row_number().over(asc))
            .withColumn("_strata", F.count(F.lit(1)).over(own))
            .withColumn("_less", F.coalesce(F.sum("n").over(asc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        )
        level = (F.lit(cap) - F.col("_less")) / (F.col("_strata") - F.col("_k") + 1)
        first_open = F.min(F.when(F.col("n") > level, F.col("_k"))).over(own)
        open_level = F.max(F.when(F.col("_k") == first_open, level)).over(own)
        share = F.when(F.col("_k") < first_open, F.col("n").cast("double")).otherwise(open_level)
    else:
        raise ValueError(f"unknown weights: {weights}")
    sizes = sizes.withColumn("_share", share).withColumn("_whole", F.floor(F.col("_share") + 1e-9))
    by_rest = own.orderBy((F.col("_share") - F.col("_whole")).desc(), F.col("n").desc(), F.col("stratum").asc_nulls_first())
    spare = F.lit(cap) - F.sum("_whole").over(own)
    can = F.when(F.col("_whole") < F.col("n"), 1).otherwise(0)
    place = F.sum(can).over(by_rest.rowsBetween(Window.unboundedPreceding, 0))
    slots = F.col("_whole") + F.when((can == 1) & (place <= spare), 1).otherwise(0)
    return sizes.select("contributor", "stratum", slots.cast("long").alias("slots"))


def _over(
    rows: DataFrame, id_col: str, contributor: Column, quality: Column, cap: int | None, share: float | None, stratum: Column | None, weights: str
) -> tuple[DataFrame, DataFrame]:
    """The rows' ids, contributors, strata and qualities, written once, and the ids that exceed their slots."""
    rows = durable(rows.select(
        F.col(id_col).alias("id"), contributor.alias("contributor"), quality.alias("quality"),
        (F.lit("") if stratum is None else F.coalesce(stratum, F.lit(""))).alias("stratum"),
    ))
    sizes = durable(rows.groupBy("contributor", "stratum").agg(F.count(F.lit(1)).alias("n")))
    if cap is None:
        cap = floor(round(share * (sizes.agg(F.sum("n")).head()[0] or 0), 6))
    # With a share, fewer than 1 / share contributors are over the cap; their slots are broadcast if they are few indeed.
    slots = durable(quotas(sizes.filter(F.col("contributor").isNotNull()), cap, weights))
    over = joined(rows, slots, ["contributor", "stratum"])
    order = [F.col("quality").desc_nulls_last(), F.col("id").asc()]
    return rows, ranked(over, ["contributor", "stratum"], order).filter(F.col("rank") > F.col("slots")).select("id")


def cap_contributors(
    rows: DataFrame, id_col: str, contributor: Column, quality: Column, *, cap: int | None = None, share: float | None = None,
    stratum: Column | None = None, weights: str = "size",
) -> DataFrame:
    """Each row's id, contributor, stratum and whether it is kept.

    No contributor keeps more than ``cap`` rows (or ``share`` of all rows, rounded down); inside a stratum those of
    highest quality stay, null quality last, ties by id ascending. Rows without a contributor belong to none and are
    kept; ids must be unique and not null. Without ``stratum`` each contributor is one stratum. An empty table gives
    an empty result.

    Sizes are aggregated before any ranking, and only rows of contributors over the cap are ranked, by range
    partitions, so one contributor with a third of all rows is spread over many tasks.
    """
    rows, over = _over(rows, id_col, contributor, quality, cap, share, stratum, weights)
    kept = F.col("_out").isNull()
    return rows.join(over.withColumn("_out", F.lit(True)), "id", "left").select("id", "contributor", "stratum", "quality", kept.alias("kept"))


def over_cap(
    rows: DataFrame, id_col: str, contributor: Column, quality: Column, *, cap: int | None = None, share: float | None = None,
    stratum: Column | None = None, weights: str = "size",
) -> DataFrame:
    """The ids that :func:`cap_contributors` removes, without passing over the rows that stay."""
    return _over(rows, id_col, contributor, quality, cap, share, stratum, weights)[1]
