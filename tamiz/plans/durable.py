"""Cutting lineage so that a lost executor costs a re-read, never a wrong or missing result."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where none is set it is an error on a cluster, whose executors share no
    local folder; a session in one process gets a temporary folder, which goes when the process ends.

    Checkpoints go with the tables that they hold if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    sc = spark.sparkContext
    if set_ := sc.getCheckpointDir():
        return set_
    if not (path := spark.conf.get("spark.checkpoint.dir", None)):
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tamiz-checkpoint-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        path = "file://" + path
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the shared checkpoint folder from then on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each evaluated once a row however often later steps name it.

    The optimizer folds a projection into those above it and pushes filters through it, which repeats costly
    expressions; it does neither through a generator, and one of a single row costs nothing.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame, below: int = 256 << 20) -> DataFrame:
    """``df`` over all cores if it is small: a small file often lies in one row group, which only one task can read, while
    its texts are work for many. Larger inputs have splits enough and are left as they are, unshuffled."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < below else df
