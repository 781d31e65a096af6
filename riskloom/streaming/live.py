"""Continuous aggregates: sliding-window request statistics and the latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.numeric import exact, ratio
from riskloom.operators.latest import latest_per_key
from riskloom.operators.ordered import group_key, value_cell
from riskloom.operators.windows import TAILS, into_windows, tail_targets, tick_values, values_of_targets
from riskloom.sources.tables import exists, remove


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    source = spark.readStream.schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return source.parquet(path)


def window_stats(
    stream: DataFrame, *, ts: str, succeeded: Column, latency: str, slide: str = "1 second", lateness: str = "1 minute",
) -> DataFrame:
    """What `write_windows` merges into sliding windows: finished ticks of ``slide``, summed per value cell.

    The state holds one histogram per unfinished tick, however many rows a tick has and however many windows cover it. Beside every
    row a mark goes in, a tick before the watermark that the row brings: the last mark to come out says up to where all ticks
    are finished, also where there are no rows. Marks have no rows of their own (``_n`` is 0).
    The event time must be a TIMESTAMP: a zone-free one cannot carry a watermark, so it is cast.
    """
    time = F.col(ts).cast("timestamp")
    mark = F.date_trunc("millisecond", time) - F.expr(f"INTERVAL {lateness}") - F.expr(f"INTERVAL {slide}")
    both = F.array(F.struct(time.alias("_time"), F.lit(1).alias("_row")), F.struct(mark.alias("_time"), F.lit(0).alias("_row")))
    timed = stream.select("*", F.inline(both)).withWatermark("_time", lateness)
    good = (F.col("_row") == 1) & F.col("_ok")
    cell = F.when(good & ~F.isnan(F.col(latency).cast("double")), value_cell(F.col(latency)))
    ticks = timed.withColumn("_ok", succeeded).withColumn("_cell", cell).groupBy(F.window("_time", slide).alias("_w"), "_cell").agg(
        F.count_if(F.col("_row") == 1).alias("_n"), F.count_if(good).alias("_good"),
        F.sum(F.when(good, exact(latency, 6))).alias("_sum"), F.max(F.when(good, F.col(latency))).alias("_max"))
    return ticks.select(F.col("_w.start").alias("_tick"), F.col("_w.end").alias("_end"), "_cell", "_n", "_good", "_sum", "_max")


def merged_windows(
    ticks: DataFrame, rows: DataFrame, after: Column, upto: Column, *, ts: str, succeeded: Column, latency: str, window_seconds: int = 30, slide_seconds: int = 1,
    percents: dict[str, float] = TAILS,
) -> DataFrame:
    """The windows that end later than ``after`` and not later than ``upto``, from all their finished ticks, with exact tails.

    Which cell a tail lies in, and at what place, comes from the ticks; the value itself is read from the stored ``rows`` of the same
    stream. A row that came too late for its windows is among the stored rows all the same; the value can then be another
    one of its cell, a thousandth away at most.
    """
    def in_reach(df: DataFrame) -> DataFrame:
        end = F.timestamp_add("SECOND", F.lit(window_seconds), F.col("window_start"))
        return df.filter((end > after) & (end <= upto))

    ticks = ticks.filter("_n > 0")
    sums = ticks.groupBy("_tick").agg(F.sum("_n").alias("_n"), F.sum("_good").alias("_good"), F.sum("_sum").alias("_sum"), F.max("_max").alias("_max"))
    stats = in_reach(into_windows(sums, window_seconds, slide_seconds)).groupBy("window_start").agg(
        F.sum("_n").alias("total"), F.sum("_good").alias("successful"), F.sum("_sum").alias("_sum"), F.max("_max").alias("max_latency"))
    stats = stats.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_add("SECOND", F.lit(window_seconds), F.col("window_start")).cast("timestamp_ntz").alias("window_end"), "total", "successful",
        ratio(F.col("successful") * 100, "total").alias("success_rate"),
        ratio(F.col("_sum").cast("double"), "successful", None).alias("avg_latency"), "max_latency")
    group = group_key([])
    cells = ticks.filter("_cell IS NOT NULL").select(group.alias("_group"), "_tick", "_cell", F.col("_good").alias("_rows"))
    targets = in_reach(tail_targets(cells, percents, window_seconds, slide_seconds))
    targets = targets.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    values = tick_values(rows.filter(succeeded), ts=ts, value=latency, by=[], slide_seconds=slide_seconds)
    found = values_of_targets(values, targets, percents, window_seconds, slide_seconds).drop("_group")
    return stats.join(found, "window_start", "left")


def write_windows(stats: DataFrame, path: str, checkpoint: str, rows: DataFrame, every: str | None = None, *, ts: str, **how) -> StreamingQuery:
    """Keep finished windows with their exact tails: one folder per batch, replaced when the batch is repeated.

    ``stats`` is what `window_stats` gives, ``rows`` the stream's source as a table; a batch reads the stretch of time of its own
    windows. Finished ticks that later windows reach back to are kept beside the checkpoint."""
    spark, kept, second = stats.sparkSession, f"{checkpoint}-ticks", 1_000_000
    reach = how.get("window_seconds", 30) * second

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            last, first = batch.agg(F.unix_micros(F.max("_end")), F.unix_micros(F.min("_tick"))).first()
            if last is None:
                return
            known = [r[0] for r in spark.read.parquet(kept).select("batch_id").distinct().collect()] if exists(spark, kept) else []
            before = max((b for b in known if b < batch_id), default=None)
            ticks, after = batch, first
            if before is not None:
                earlier = spark.read.parquet(f"{kept}/batch_id={before}")
                after = earlier.agg(F.unix_micros(F.max("_end"))).first()[0]
                ticks = earlier.unionByName(batch)
            at = lambda micros: F.timestamp_micros(F.lit(micros))
            part = rows.filter((F.col(ts) >= at(after - reach).cast("timestamp_ntz")) & (F.col(ts) < at(last).cast("timestamp_ntz")))
            merged_windows(ticks, part, at(after), at(last), ts=ts, **how).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            ticks.filter(F.col("_tick") > at(last - reach)).write.mode("overwrite").parquet(f"{kept}/batch_id={batch_id}")
            for old in known:
                if before is not None and old < before:
                    remove(spark, f"{kept}/batch_id={old}")
        finally:
            batch.unpersist()

    writer = stats.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def write_stream(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append finished rows to Parquet, exactly once."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def keep_latest(
    stream: DataFrame, path: str, checkpoint: str, *, keys: list[str], ts: str, tiebreak: tuple[str, ...] = (), every: str | None = None,
) -> StreamingQuery:
    """Maintain a latest-row-per-key table as a base plus changes: a batch writes one row per key it
    touched, under its batch id, so a retried batch replaces its own rows and untouched keys cost
    nothing. Read it with ``latest_table``; fold changes into the base with ``compact_latest``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, keys, ts, tiebreak).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def latest_table(spark: SparkSession, path: str, *, keys: list[str], ts: str, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The current row of every key: the newest base merged with the changes after it."""
    changes = spark.read.parquet(f"{path}/changes")
    upto = _base(spark, path)
    rows = changes.filter(F.col("batch_id") > upto).drop("batch_id")
    if upto >= 0:
        rows = spark.read.parquet(f"{path}/base/upto={upto}").unionByName(rows)
    return latest_per_key(rows, keys, ts, tiebreak)


def compact_latest(spark: SparkSession, path: str, *, keys: list[str], ts: str, tiebreak: tuple[str, ...] = ()) -> int:
    """Write the current table as a new base; returns the last batch id it holds. A base counts
    only once its commit row is there, so readers never see half of one."""
    newest = spark.read.parquet(f"{path}/changes").agg(F.max("batch_id")).first()[0]
    if newest > _base(spark, path):
        rows = latest_table(spark, path, keys=keys, ts=ts, tiebreak=tiebreak)
        rows.write.mode("overwrite").parquet(f"{path}/base/upto={newest}")
        spark.range(1).select(F.lit(newest).cast("long").alias("upto")).write.mode("append").parquet(f"{path}/commits")
    return newest


def _base(spark: SparkSession, path: str) -> int:
    if not exists(spark, f"{path}/commits"):
        return -1
    return spark.read.parquet(f"{path}/commits").agg(F.max("upto")).first()[0]
