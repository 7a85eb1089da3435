"""What the operators of this subpackage share: records of raw, exact ranks and exact quantiles at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators.ordered import ranked

__all__ = ["exact_medians", "joined", "ranked", "records", "source_of", "split_of", "table"]

#: The spellings of each split, after trimming and lower-casing.
SPLIT_SPELLINGS = {
    "train": ("train", "training"),
    "validation": ("validation", "valid", "val", "dev"),
    "test": ("test", "testing"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_of(chunk_id: str | Column = "chunk_id") -> Column:
    """The ``pdf_id`` inside a ``chunk_id`` (``{pdf_id}_{number}``); null where there is none."""
    found = F.regexp_extract(F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id, r"^(.*)_[0-9]+$", 1)
    return F.when(found != "", found)


def split_of(split: str | Column = "split") -> Column:
    """One spelling per split; null for blank, null and unknown spellings."""
    text = F.lower(F.trim(F.col(split) if isinstance(split, str) else split))
    out = F.lit(None).cast("string")
    for name, spellings in SPLIT_SPELLINGS.items():
        out = F.when(text.isin(*spellings), F.lit(name)).otherwise(out)
    return out


def records(raw: DataFrame, **columns: Column) -> DataFrame:
    """One row per ``qa_id``, that of the earliest delivery (lowest ``row_no``); rows without ``qa_id`` are no records."""
    value = F.struct(*[c.alias(n) for n, c in columns.items()])
    return (
        raw.filter(F.col("qa_id").isNotNull())
        .select("qa_id", F.col("row_no").alias("_row"), value.alias("_value"))
        .groupBy("qa_id")
        .agg(F.min_by("_value", "_row").alias("_value"))
        .select("qa_id", "_value.*")
    )


#: Rows of a joined table up to which it is broadcast, and how many copies of a larger one share out a hot key.
BROADCAST_ROWS, SALTS = 200_000, 32


def joined(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with a durable ``table`` that has one row per key, whatever the share of rows that one key holds: a table
    of up to BROADCAST_ROWS rows is broadcast, of a larger one each salt of the rows meets its own copy. ``how``: 'inner' or 'left'."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), list(keys), how)
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def exact_medians(df: DataFrame, columns: Sequence[str], buckets: int = 1024) -> dict[str, float | None]:
    """The exact median of each numeric column (null values left out; null for a column without values).

    Histograms are refined around the wanted ranks: a pass returns at most ``2 * buckets`` counts a column to the
    driver, whatever the number of rows, and ends when the bucket of a rank holds a single value.
    """
    first = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).head()
    values: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i in range(len(columns)):
        n, lo, hi = first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"]
        for rank in {(n - 1) // 2, n // 2} if n else ():
            if lo == hi:
                values[i, rank] = float(lo)
            else:
                open_[i, rank] = (float(lo), float(hi), rank)
    while open_:
        targets = sorted(open_)
        each = []
        for k, t in enumerate(targets):
            lo, hi, _ = open_[t]
            v = F.col(columns[t[0]]).cast("double")
            at = F.least(F.floor((v - F.lit(lo)) / F.lit((hi - lo) / buckets)), F.lit(buckets - 1))
            each.append(F.when(v.between(lo, hi), F.struct(F.lit(k).alias("k"), at.alias("b"), v.alias("v"))))
        hist = (
            df.select(F.explode(F.array_compact(F.array(*each))).alias("x"))
            .groupBy("x.k", "x.b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
            .collect()
        )
        for k, t in enumerate(targets):
            left = open_.pop(t)[2]
            for r in sorted((r for r in hist if r["k"] == k), key=lambda r: r["b"]):
                if left < r["n"]:
                    if r["lo"] == r["hi"]:
                        values[t] = r["lo"]
                    elif r["n"] == 2:
                        values[t] = r["lo"] if left == 0 else r["hi"]
                    else:
                        open_[t] = (r["lo"], r["hi"], left)
                    break
                left -= r["n"]
    out: dict[str, float | None] = {}
    for i, c in enumerate(columns):
        own = [v for (j, _), v in values.items() if j == i]
        out[c] = sum(own) / len(own) if own else None
    return out
