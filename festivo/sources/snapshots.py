"""Tables delivered as dated snapshots: one folder a day, read by partition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

SNAPSHOT = "snapshot_date"


class SnapshotTable:
    """A table of which every day's delivery is a folder ``snapshot_date=yyyy-MM-dd`` below one root.

    Readers name the days they want on the partition column, so Spark lists and opens those folders only; which days
    there are is read from the folders' names, without opening a file.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def deliver(self, rows: DataFrame) -> SnapshotTable:
        """Write the days that ``rows`` holds; a day delivered again replaces that day alone."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(SNAPSHOT).parquet(self.root)
        return self

    def dates(self) -> list[date]:
        """Delivered days, oldest first."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [str(f.getPath().getName()) for f in files.listStatus(path)]
        return sorted(date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith(f"{SNAPSHOT}="))

    def read(self) -> DataFrame:
        """All snapshots; the snapshot date is a date column."""
        rows = self.spark.read.option("basePath", self.root).parquet(self.root)
        return rows.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))

    def on(self, day: date) -> DataFrame:
        """One day's delivery; a day without one gives no rows."""
        return self.read().filter(F.col(SNAPSHOT) == F.lit(day))

    def since(self, first: date, last: date) -> DataFrame:
        """Deliveries of the days from ``first`` to ``last``."""
        return self.read().filter(F.col(SNAPSHOT).between(F.lit(first), F.lit(last)))

    def newest(self, as_of: date) -> DataFrame:
        """The newest delivery up to a day; without one an error."""
        known = [d for d in self.dates() if d <= as_of]
        if not known:
            raise ValueError(f"no snapshot of {self.root} up to {as_of}")
        return self.on(known[-1])

    def on_days_of(self, days: DataFrame, day: str) -> DataFrame:
        """Deliveries of the days a small table names; Spark prunes the other folders while the query runs."""
        wanted = days.select(F.col(day).alias(SNAPSHOT)).dropDuplicates()
        return self.read().join(wanted, SNAPSHOT)
