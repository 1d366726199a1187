"""Helpers shared by every package: loading tables, repeated deliveries, lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_delivery(df: DataFrame, key: str, within: str | None = None) -> DataFrame:
    """One row for each ``key``: repeated deliveries carry the same content, so any of them will do.

    ``within`` names the key of a larger unit (an upload) that later steps group or order by: the
    rows are then brought together by that unit once, and the later steps shuffle no more.
    Rows with a null key are kept as they are one row (Spark groups nulls together).
    """
    if within:
        return df.repartition(within).dropDuplicates([within, key])
    return df.dropDuplicates([key])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir.

    A folder of our own is only made in local mode, where one machine is the whole cluster; elsewhere
    executors could not read what others wrote, so a missing setting is an error.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can read")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="examflow-checkpoints-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in a folder all executors share: survives the loss of any of them.

    Spark deletes its files with the frame if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
