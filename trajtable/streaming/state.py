"""Per-epoch state tables for ``foreachBatch``.

An epoch reads the state its predecessor wrote and writes only its own folder, so a micro-batch that
is run again gives the same result. State is relational and shuffled by key like any other table:
no key has to fit one task.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def before(self, epoch: int) -> DataFrame:
        """State left by the previous epoch (empty for the first)."""
        if epoch == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch={epoch - 1}")

    def write(self, rows: DataFrame, epoch: int) -> DataFrame:
        names = [c.split()[0] for c in self.schema.split(", ")]
        rows.select(*names).write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch={epoch}")

    def forget(self, epoch: int) -> None:
        """Remove the state that no run of this or a later epoch can read."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/epoch={epoch - 2}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def all(self) -> DataFrame:
        """Rows of every epoch, for append-only outputs."""
        return self.spark.read.option("basePath", self.path).schema(f"{self.schema}, epoch int").parquet(f"{self.path}/epoch=*")


def run_epochs(stream: DataFrame, folder: str, step: Callable[[DataFrame, int], None]) -> int:
    """Process everything that is available, one epoch per micro-batch; returns the last epoch."""
    query = (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query.lastProgress["batchId"]


def run_append(stream: DataFrame, folder: str) -> DataFrame:
    """Append a stream to a parquet table (exactly once) and return the table."""
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
    if late:
        logging.getLogger(__name__).warning("%d rows came after the watermark and were left out", late)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")
