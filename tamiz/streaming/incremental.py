"""New files into a keyed table: each micro-batch replaces the rows of its sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def upsert_by_source(
    spark: SparkSession, path: str, schema: str, target: str, checkpoint: str, source: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    buckets: int = 64, append: str | None = None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Takes the files that are new below ``path``, and writes their rows into ``target``.

    The table lies in ``buckets`` folders by a hash of the source. A batch reads the folders that its sources fall into, takes its
    own sources' rows out of them, puts the new ones in, and overwrites these folders alone: a source delivered anew replaces its
    old rows, other sources of the folder stay, and a batch that is run again after a failure leaves the same table. With
    ``append`` the rows of a source whose files are spread over batches are kept, each row once (by ``append``, its key). Ends when
    there are no more new files.
    """
    from tamiz.plans.durable import durable
    from tamiz.sources.files import exists

    name = F.coalesce(F.col(source).cast("string"), F.lit("unknown"))
    bucket = F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, _: int) -> None:
        new = durable(transform(batch).withColumn("_bucket", bucket))
        touched = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]
        if not touched:
            return
        out = new
        if exists(spark, f"{target}/_bucket=*"):
            old = spark.read.schema(new.schema).option("basePath", target).parquet(target).filter(F.col("_bucket").isin(touched))
            gone = new.select(append or name.alias("_gone")).distinct()
            kept = old.join(gone, append, "left_anti") if append else old.join(gone, name == F.col("_gone"), "left_anti")
            out = new.unionByName(durable(kept))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(target)

    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@contextmanager
def staging(spark: SparkSession, keep: bool = False) -> Iterator[str]:
    """A folder for a run's intermediate tables beside the checkpoints; removed at the end, also after a failure, unless kept."""
    from uuid import uuid4

    from tamiz.plans.durable import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/staging-{uuid4().hex}"
    try:
        yield path
    finally:
        if not keep:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def progress(statuses: DataFrame, status: str, total: int, seconds: float) -> DataFrame:
    """One row on how far a resumable run is: done (``ok``, ``empty``, ``refused``: final), ``failed`` (to be tried again), pending, the rate, and the
    seconds left at that rate (null before the first)."""
    done = F.count_if(F.col(status).isin("ok", "empty", "refused"))
    out = statuses.agg(done.alias("done"), F.count_if(F.col(status) == "failed").alias("failed"), *[F.count_if(F.col(status) == s).alias(s) for s in ("ok", "empty", "refused")])
    rate = F.try_divide(F.col("done").cast("double"), F.lit(float(seconds)))
    return out.withColumn("pending", F.lit(total).cast("long") - F.col("done")).withColumn("per_second", rate).withColumn("seconds_left", F.try_divide(F.col("pending").cast("double"), rate))


def resumable(spark: SparkSession, path: str, schema: str, target: str, checkpoint: str, key: str, process: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Runs ``process`` over rows that are new below ``path``, once per key: keys already in ``target`` are left out, so
    a batch run again after a failure adds nothing twice."""
    from tamiz.operators.incremental import pending
    from tamiz.sources.files import exists

    def write(batch: DataFrame, _: int) -> None:
        rows = pending(batch, spark.read.parquet(target), key) if exists(spark, f"{target}/_SUCCESS") else batch
        process(rows.dropDuplicates([key])).write.mode("append").parquet(target)

    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums of events by kind and window; works on a stream, where rows later than ``late`` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("start"), kind, "n", "total"
    )
