"""Reading inputs, writing outputs, and staging intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a table folder."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def write_table(
    df: DataFrame, path: str, fmt: str = "orc", partition_by: Sequence[str] = ()
) -> None:
    """Materialise an output as an ORC (or parquet) table at a location."""
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)


def write_partitions(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "orc") -> None:
    """Write a table of several runs: the partitions that ``df`` holds replace their predecessors, all others stay.

    Spark writes the new files to a staging folder and moves them when the job commits, so a run that fails leaves the old
    partitions in place, and running it again gives the same table.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).format(fmt).save(path)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the session's checkpoint folder.

    Only a local session may fall back to a folder of its own; on a cluster the
    folder has to be one every executor can read.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
    root = tempfile.mkdtemp(prefix="festivo-stage-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def new_staging_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for one staged table."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where several consumers would otherwise recompute the same lineage; the
    written table survives the loss of executors and keeps its column statistics.
    """
    spark = df.sparkSession
    path = new_staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
