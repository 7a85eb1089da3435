"""Incremental runs: what changed, keyed replacement, appending, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import text as tx
from tamiz.operators.chunks import best_of_duplicates, numbered


def changed_files(files: DataFrame, state: DataFrame, path: str = "source_path", fields: tuple[str, ...] = ("file_size",), force: bool = False) -> DataFrame:
    """``files`` with ``change``: ``new``, or ``changed`` in one of ``fields``; unchanged files are left out unless ``force``.

    Deletions aren't noticed. A state with several rows for a path counts by its last (greatest) values.
    """
    known = state.groupBy(F.col(path).alias("_path")).agg(*[F.max(c).alias(f"_{c}") for c in fields])
    out = files.join(known, F.col(path) == F.col("_path"), "left")
    differs = F.lit(force)
    for c in fields:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = out.withColumn("change", F.when(F.col("_path").isNull(), "new").when(differs, "changed"))
    return out.filter(F.col("change").isNotNull()).drop("_path", *[f"_{c}" for c in fields])


def bootstrapped(files: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """The state with which a first incremental run begins where pages exist already: the fingerprints of those files, by ``key``, that have
    pages, so that they aren't processed again."""
    there = pages.select(F.col(key).alias("_k")).filter(F.coalesce(F.col("_k"), F.lit("")) != "").distinct()
    return files.join(there, F.col(key) == F.col("_k"), "left_semi")


def replaced(existing: DataFrame, new: DataFrame, path: str, name: str) -> DataFrame:
    """``new`` and those of ``existing`` whose path and name are both not among its own; blank and null keys match nothing."""
    keys = lambda c: new.select(F.col(c).alias("_k")).filter(F.coalesce(F.col("_k"), F.lit("")) != "").distinct()
    kept = existing
    for c in dict.fromkeys((path, name)):
        kept = kept.join(keys(c), F.col(c) == F.col("_k"), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def chunk_key(text: Column | str) -> Column:
    """The first 240 words in lower case, accents kept; not the key that duplicates within a batch go by."""
    t = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    words = F.trim(F.regexp_replace(F.regexp_replace(t, rf"[^a-z0-9áéíóúüñ]", " "), " +", " "))
    return F.array_join(F.slice(F.split(words, " "), 1, 240), " ")


def appended(existing: DataFrame, new: DataFrame, text: str, source: str, order: list[Column]) -> DataFrame:
    """The rows of ``new`` that are accepted beside ``existing``: the best of each duplicate, none whose key exists already, numbered on from
    the greatest number of each source."""
    known = existing.filter(F.coalesce(F.col(text), F.lit("")) != "").select(F.sha2(chunk_key(text), 256).alias("_known")).distinct()
    fresh = best_of_duplicates(new, text, order).withColumn("_key", F.sha2(chunk_key(text), 256))
    fresh = fresh.filter(chunk_key(text) != "").join(known, F.col("_key") == F.col("_known"), "left_anti")
    least = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*new.columns).alias("_row")))
    fresh = fresh.groupBy("_key").agg(least.alias("_m")).select("_m._row.*")
    parts = existing.select(F.regexp_extract("chunk_id", r"^(.+)_([0-9]{5})$", 1).alias("_prefix"), F.regexp_extract("chunk_id", r"^(.+)_([0-9]{5})$", 2).alias("_n"))
    start = parts.filter("_prefix <> ''").groupBy("_prefix").agg(F.max(F.col("_n").cast("long")).alias("_from"))
    return numbered(fresh, tx.slugify(source), order, start=start)


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done; rows without a key are pending."""
    keys = done.select(F.col(key).alias("_k")).filter(F.coalesce(F.trim(F.col("_k")), F.lit("")) != "").distinct()
    return rows.join(keys, F.col(key) == F.col("_k"), "left_anti")
