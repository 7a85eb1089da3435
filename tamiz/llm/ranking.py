"""Problem 5: one ranking from several differently scaled scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import exact_medians, ranked
from tamiz.plans.durable import durable

#: The median absolute deviation times this is the standard deviation of normal values; beyond this
#: many robust deviations the logistic function is 0 or 1 in double precision.
MAD_TO_SIGMA, MOST = 1.4826, 30.0


def combined_scores(rows: DataFrame, id_col: str, weights: dict[str, float]) -> DataFrame:
    """(``id``, ``combined``) of the rows in which all scores are present (null and NaN count as missing).

    Each score is centred on its exact median, divided by 1.4826 times its exact median absolute deviation, squashed
    by the logistic function, and the bounded values are joined by a weighted geometric mean. A score whose deviation
    is 0 is divided by its mean absolute deviation, and is 1/2 throughout if that is 0 too.
    """
    scores = list(weights)
    ok = F.lit(True)
    for c in scores:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    base = durable(rows.filter(ok).select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"s{i}") for i, c in enumerate(scores)]))
    names = [f"s{i}" for i in range(len(scores))]
    centre = exact_medians(base, names)
    away = base.select(*[F.abs(F.col(c) - F.lit(centre[c])).alias(c) for c in names])
    spread = exact_medians(away, names)
    mean = away.agg(*[F.avg(c).alias(c) for c in names]).head()
    log_mean = F.lit(0.0)
    for c, w in zip(names, weights.values(), strict=True):
        scale = (spread[c] or 0.0) * MAD_TO_SIGMA or mean[c] or 1.0
        z = F.least(F.greatest((F.col(c) - F.lit(centre[c])) / F.lit(scale), F.lit(-MOST)), F.lit(MOST))
        log_mean = log_mean - F.lit(w / sum(weights.values())) * F.log1p(F.exp(-z))
    return base.select("id", F.exp(log_mean).alias("combined"))


def best(scored: DataFrame, share: float | None = None, buckets: int = 4096) -> DataFrame:
    """``scored`` with its ``rank`` (best first, ties by id); only the first ``share`` of it (rounded down) if given.

    For a share, a histogram of ``buckets`` counts tells first which rows can be among them, and only these are ranked.
    """
    order = [F.col("combined").desc(), F.col("id").asc()]
    if share is None:
        return ranked(scored, [], order)
    at = F.least(F.floor(F.col("combined") * buckets), F.lit(buckets - 1))
    counts = {r["at"]: r["n"] for r in scored.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = int(sum(counts.values()) * share + 1e-9)
    above, least = 0, buckets
    for b in sorted(counts, reverse=True):
        if above >= n:
            break
        above, least = above + counts[b], b
    return ranked(scored.filter(at >= least), [], order).filter(F.col("rank") <= n)
