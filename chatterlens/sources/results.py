"""Tables that streaming batches write to: replaying a batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


class BatchTable:
    """Parquet rows kept apart by the batch that wrote them; a replay overwrites its own rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, before: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, or only those of earlier batches."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        rows = self.spark.read.schema(f"{self.schema}, batch_id bigint").parquet(self.path)
        return rows if before is None else rows.filter(F.col("batch_id") < before)

    def has_batch(self, batch_id: int) -> bool:
        """Whether the batch is committed; its folder alone exists before any row does."""
        return path_exists(self.spark, f"{self.path}/batch_id={batch_id}/_SUCCESS")

    def read_batch(self, batch_id: int) -> DataFrame:
        if not self.has_batch(batch_id):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def _batches(self) -> list[int]:
        """The numbers of all batch folders, committed or not, newest first."""
        if not path_exists(self.spark, self.path):
            return []
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)
        names = [status.getPath().getName() for status in found]
        return sorted((int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")), reverse=True)

    def newest_batch(self) -> int:
        """The last committed batch, -1 if there is none."""
        return next((b for b in self._batches() if self.has_batch(b)), -1)

    def forget(self, before: int) -> None:
        """Remove the batches before number ``before``."""
        for batch_id in self._batches() if before > 0 else []:
            if batch_id < before:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={batch_id}")
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


class ResultTable(BatchTable):
    """Keyed results: the row of the newest batch wins."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        super().__init__(spark, path, schema)
        self.keys = keys

    def current(self) -> DataFrame:
        rows = self.read()
        rest = [c for c in rows.columns if c not in self.keys]
        newest = F.max_by(F.struct(*rest), "batch_id").alias("_row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_row.*").drop("batch_id")
