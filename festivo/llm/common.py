"""Helpers shared by the operators: scratch tables, row keys, word splitting, batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from festivo.sources.tables import staging_root

BATCH_BYTES = 8 << 20


class Scratch:
    """Intermediate tables of one run, in a folder of their own below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame, codec: str = "snappy") -> DataFrame:
        """Write a table once and read it back: lineage is cut and lost executors recompute nothing before it."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a kept table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a model of bounded size, classes included."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> object:
    return cloudpickle.loads(shared.value)


def row_key(*cols: Column | str) -> Column:
    """64-bit key of a row's values; joins use it together with doc_id."""
    return F.xxhash64(*cols)


def crc_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of one text column, never splitting a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).cumsum()
        start = 0
        while start < batch.num_rows:
            base = offsets[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(offsets, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
