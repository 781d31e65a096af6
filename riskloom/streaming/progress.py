"""The progress of streams as a table: one row per batch, appended while the streams run."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from riskloom.sources import tables

PROGRESS = StructType([
    StructField("query_id", StringType()), StructField("run_id", StringType()), StructField("name", StringType()), StructField("batch_id", LongType()),
    StructField("at", StringType()), StructField("input_rows", LongType()), StructField("rows_per_second", DoubleType()),
    StructField("duration_ms", LongType()), StructField("watermark", StringType()), StructField("state_rows", LongType())])


class ProgressRows(StreamingQueryListener):
    """Appends a row for every batch that a query of the session completes. Add it with ``spark.streams.addListener``.

    Appends do not disturb each other, so any number of sessions can keep one table. A batch that is
    repeated after a failure has a row of each run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        tables.ensure_table(spark, path, PROGRESS)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond or 0), p.batchDuration,
               (p.eventTime or {}).get("watermark"), sum(o.numRowsTotal for o in p.stateOperators))
        tables.append(self.spark.createDataFrame([row], PROGRESS), self.path, PROGRESS)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        """Whether a run has ended and all its rows are there; the listener hears of both some time after the fact."""
        with self._changed:
            return self._changed.wait_for(lambda: run_id in self._ended, seconds)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Per query: batches, rows, rows per second over the time spent, the slowest batch, the newest watermark."""
    rows = spark.read.schema(PROGRESS).parquet(path)
    return rows.groupBy("query_id", "name").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.try_divide(F.sum("input_rows") * 1000, F.sum("duration_ms")).alias("rows_per_second"),
        F.max("duration_ms").alias("slowest_ms"), F.max("watermark").alias("watermark"), F.max_by("state_rows", "batch_id").alias("state_rows"))
