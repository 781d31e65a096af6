"""Incremental processing of the serving log.

``process_increment`` is the batch form with a high-water mark: it takes the rows in (mark, newest]
and moves the mark. Rows that arrive later with a time at or before the mark are not processed
(``late_rows`` counts them). ``start_stream`` is the continuous form: the file source remembers which files it has
read, so late rows are not lost, and results are kept per batch id, so a retried batch replaces
its own output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom import fixed_values as fv
from riskloom.functions.times import clock, instant
from riskloom.operators.prep import Encoder, Scaler, transform_struct
from riskloom.schemas import INFERENCE_LOG, WATERMARK
from riskloom.sources import tables
from riskloom.sources.publish import publish_text, published, read_text
from riskloom.sources.serving_log import DEFAULT_PREFIX, LogKeys, extract, json_attribute


def is_function(log: DataFrame, name: str = "predict", prefix: str = DEFAULT_PREFIX) -> Column:
    """Case-insensitive function name: the real column when the log has one, else the JSON attribute."""
    text = F.col("function_name") if "function_name" in log.columns else json_attribute("record_attributes", LogKeys(prefix).function_name)
    return F.lower(text) == name


def new_mark(log: DataFrame, mark, condition: Column | None = None, ts: str = "timestamp") -> DataFrame:
    """One row: the newest time after ``mark`` among the wanted rows, NULL when there is none."""
    fresh = _not_before_day(log, mark).filter(F.col(ts) > instant(mark))
    if condition is not None:
        fresh = fresh.filter(condition)
    return fresh.agg(F.max(ts).alias("new_mark"))


def interval(log: DataFrame, low, high, condition: Column | None = None, ts: str = "timestamp") -> DataFrame:
    """Rows with low < time <= high."""
    rows = _not_before_day(log, low).filter((F.col(ts) > instant(low)) & (F.col(ts) <= instant(high)))
    return rows if condition is None else rows.filter(condition)


def _not_before_day(log: DataFrame, mark) -> DataFrame:
    """Skip the day folders before the mark, where the log has them."""
    return log.filter(F.col("log_date") >= instant(mark).cast("date")) if "log_date" in log.columns else log


def late_rows(log: DataFrame, results: DataFrame, mark, *, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """One row: how many wanted log rows at or before ``mark`` never became results. An audit: it
    reads the whole log, which the increments themselves do not."""
    logged = log.filter((F.col("timestamp") <= instant(mark)) & is_function(log, prefix=prefix)).agg(F.count("*").alias("n"))
    done = results.filter(F.col("inference_timestamp") <= instant(mark)).agg(F.count("*").alias("n"))
    return logged.select((F.col("n") - done.scalar()).alias("late_rows"))


def transformation_rows(log: DataFrame, encoder: Encoder, scaler: Scaler, *, prefix: str = DEFAULT_PREFIX, at=None) -> DataFrame:
    """Log records as result rows: ids, the 22 inputs, the prediction, the 22 transformed features."""
    t = transform_struct(extract(log, prefix), encoder, scaler)
    have = t.schema["t"].dataType.fieldNames()

    def feature(name: str) -> Column:
        return (F.col("t")[name] if name in have else F.lit(None)).cast("double")

    return t.select(
        F.col("timestamp").alias("inference_timestamp"), "query_id", "service_name", "function_name",
        clock(at).alias("transform_timestamp"),
        *[F.col(c).alias(f"{c}_input") for c in fv.MODEL_INPUT_COLS],
        fv.PREDICTION_COL,
        *[feature(c).alias(f"{c}_transformed") for c in fv.NUMERIC_COLS],
        *[feature(c).alias(c) for c in fv.ENCODED_COLS])


# --- batch form ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Progress:
    rows: int
    mark: object

    @property
    def message(self) -> str:
        if self.mark is None:
            return fv.NOTHING_NEW_MESSAGE
        return fv.PROGRESS_MESSAGE.format(rows=self.rows, mark=self.mark)


class Watermarks(tables.StateTable):
    """Marks by key, kept as snapshots; a key that is absent starts at 1970."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, WATERMARK)

    def start(self, key: str = fv.WATERMARK_KEY) -> None:
        """Insert the key unless it is there."""
        fresh = self.spark.range(1).select(
            F.lit(key).alias("watermark_key"), instant(fv.WATERMARK_START).alias("last_processed"))
        if self.read().filter(F.col("watermark_key") == key).isEmpty():
            self.update(lambda now: tables.insert_absent(now, fresh, ["watermark_key"]))

    def mark(self, key: str = fv.WATERMARK_KEY):
        return self.read().filter(F.col("watermark_key") == key).first()["last_processed"]

    def claim(self, low, high, key: str = fv.WATERMARK_KEY):
        """Where the interval after ``low`` ends: at ``high``, unless a job before or beside this one has said otherwise.

        It is decided once, so all tries at an interval process the same rows."""
        path = self._claim(low, key)
        publish_text(self.spark, path, high.isoformat())
        return datetime.fromisoformat(read_text(self.spark, path))

    def _claim(self, low, key: str) -> str:
        return f"{self.path}/claims/{quote(key, safe='')}/{low:%Y%m%dT%H%M%S%f}"

    def advance(self, mark, key: str = fv.WATERMARK_KEY, since=None) -> bool:
        """Move a mark. With ``since``, only from there: False if another job has moved it already."""
        moved = []

        def change(now: DataFrame) -> DataFrame:
            here = now.filter(F.col("watermark_key") == key).first()
            moved[:] = [since is None or here is not None and here["last_processed"] == since]
            update = self.spark.range(1).filter(F.lit(moved[0])).select(F.lit(key).alias("watermark_key"), instant(mark).alias("last_processed"))
            return tables.keyed_update(now, update, ["watermark_key"])

        self.update(change)
        if moved[0] and since is not None:
            tables.remove(self.spark, self._claim(since, key))
        return moved[0]


def process_increment(
    log: DataFrame, marks: Watermarks, results_path: str, to_results: Callable[[DataFrame], DataFrame], *,
    key: str = fv.WATERMARK_KEY, prefix: str = DEFAULT_PREFIX,
) -> Progress:
    """Process what is new in the log and move the mark. Any number of jobs may do so at once.

    The interval's end is agreed on first, its results are written to a folder of this try, and that
    folder gets the interval's name unless another try has been faster. If the job dies before the
    mark moves, the next run finds the interval claimed, perhaps written, and goes on from there; of
    two jobs at one interval the results of one stay, and one of them moves the mark.
    """
    marks.start(key)
    low = marks.mark(key)
    wanted = is_function(log, prefix=prefix)
    high = new_mark(log, low, wanted).first()["new_mark"]
    if high is None:
        return Progress(0, None)
    high = marks.claim(low, high, key)
    spark = log.sparkSession
    folder = f"{results_path}/mark={quote(key, safe='')}/after={low:%Y%m%dT%H%M%S%f}"
    if tables.exists(spark, folder):
        done = spark.read.parquet(folder).count()
    else:
        seen = Observation()
        attempt = f"{results_path}/_attempts/{uuid.uuid4().hex}"
        rows = to_results(interval(log, low, high, wanted)).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(attempt)
        done = seen.get["rows"]
        if not published(spark, attempt, folder):
            tables.remove(spark, attempt)
    marks.advance(high, key, low)
    return Progress(done, high)


# --- continuous form ----------------------------------------------------------------------------

def start_stream(
    spark: SparkSession, log_path: str, results_path: str, checkpoint_path: str,
    to_results: Callable[[DataFrame], DataFrame], *, schema=INFERENCE_LOG, every: str | None = None,
    files_per_batch: int | None = None, prefix: str = DEFAULT_PREFIX, condition: Callable[[DataFrame], Column] | None = None,
) -> StreamingQuery:
    """Follow the log folder. ``every`` is a trigger interval ('5 minutes'); without it the query
    processes all that is there and stops."""
    source = spark.readStream.schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    log = source.parquet(log_path)
    wanted = is_function(log, prefix=prefix) if condition is None else condition(log)

    def write(batch: DataFrame, batch_id: int) -> None:
        to_results(batch).write.mode("overwrite").parquet(f"{results_path}/batch_id={batch_id}")

    writer = log.filter(wanted).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def progress_of(query: StreamingQuery) -> dict:
    """Batch id and row counts of the last batch."""
    last = query.lastProgress
    return {} if last is None else {"batch_id": last["batchId"], "input_rows": last["numInputRows"]}
