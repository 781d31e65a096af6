"""Summaries of measures and request logs: describe, latency, rates, error counts, histograms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import exact, exact_avg, ratio, rounded
from riskloom.functions.text import head_chars
from riskloom.functions.times import clock, shift
from riskloom.operators.ordered import group_key, interpolated_quantiles, nearest_rank_percentiles
from riskloom.operators.windows import TAILS, window_tails
from riskloom.sources.scratch import written

LATENCY_PERCENTS = {"p50": 50, "p95": 95, "p99": 99}


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows for numeric columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count, mean, sample std, min, exact interpolated quartiles, max."""
    values = long_form(df, columns)
    value = F.when(~F.isnan("value"), F.col("value"))
    moments = values.groupBy("column").agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    quartiles = interpolated_quantiles(values, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles.drop("n"), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def min_max_mean(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"))


def distinct_texts(c: str) -> Column:
    """Distinct values, without NULL and the empty string."""
    return F.count_distinct(F.nullif(F.col(c), F.lit("")))


def latency_stats(df: DataFrame, by: list[str], latency: str, query_id: str) -> DataFrame:
    """Rows, mean/min/max and nearest-rank p50/p95/p99 of the latency, distinct queries; per group.

    Rows without a latency count as rows but stay out of the latency figures; a group without any
    latency shows 0 for the percentiles.
    """
    if not by:
        return latency_stats(df.withColumn("_all", F.lit(0)), ["_all"], latency, query_id).drop("_all")
    # Distinct in two steps: the pairs shuffle on (group, query), so one group is not one task.
    per_query = df.groupBy(*by, query_id).agg(
        F.count("*").alias("_rows"), F.sum(exact(latency, 6)).alias("_sum"),
        F.count(latency).alias("_n"), F.min(latency).alias("_min"), F.max(latency).alias("_max"))
    named = F.when(F.col(query_id).cast("string") != "", F.lit(1))
    stats = per_query.groupBy(*by).agg(
        F.sum("_rows").alias("total_inferences"),
        F.sum("_sum").cast("double").alias("_sum"), F.sum("_n").alias("_n"),
        F.min("_min").alias("min_latency_ms"), F.max("_max").alias("max_latency_ms"),
        F.count(named).alias("unique_queries"))
    percentiles = nearest_rank_percentiles(df, by, latency, LATENCY_PERCENTS).drop("n")
    return stats.join(percentiles, by, "left").select(
        *by, "total_inferences", ratio("_sum", "_n", None).alias("avg_latency_ms"),
        "min_latency_ms", "max_latency_ms",
        *[F.coalesce(p, F.lit(0.0)).alias(f"{p}_latency_ms") for p in LATENCY_PERCENTS],
        "unique_queries")


def status_rates(df: DataFrame, by: list[str], succeeded: Column, seconds: Column | float) -> DataFrame:
    """Totals, successes, failures, success rate in percent, rows per second."""
    total, good = F.count("*"), F.count_if(succeeded)
    seconds = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return df.groupBy(*by).agg(
        total.alias("total"), good.alias("successful"), (total - good).alias("failed"),
        ratio(good * 100, total).alias("success_rate"), ratio(total, seconds).alias("throughput"))


def category_counts(df: DataFrame, succeeded: Column, category: str) -> DataFrame:
    """Rows by category over the successes."""
    return df.filter(succeeded).groupBy(category).agg(F.count("*").alias("n"))


def error_frequency(df: DataFrame, error: str, chars: int = 80) -> DataFrame:
    """Error texts by their first ``chars`` characters, most frequent first; a missing text is 'Unknown'."""
    text = head_chars(F.coalesce(F.col(error), F.lit("Unknown")), chars)
    return df.groupBy(text.alias("error")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error")


def histogram(df: DataFrame, value: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins of [lo, hi]; the last bin includes ``hi``.

    The ends come from the data when not given. Values outside given ends, NULL and NaN are left
    out. Only non-empty bins appear; equal ends put everything into bin 0.
    """
    measured = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if lo is None or hi is None:
        # The values are read twice, for the ends and for the counts; what they are computed from may be dear.
        measured = written(measured, "histogram")
        # One row of two numbers: as literals they cost nothing where the bins are computed.
        ends = measured.agg(F.min("v"), F.max("v")).first()
        lo = ends[0] if lo is None else lo
        hi = ends[1] if hi is None else hi
    low, high = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    bin_no = F.when(high > low, F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    width = (high - low) / bins
    return (
        measured.filter((F.col("v") >= low) & (F.col("v") <= high))
        .groupBy(bin_no.cast("int").alias("bin")).agg(F.count("*").alias("n"))
        .select("bin", (low + F.col("bin") * width).alias("bin_start"), (low + (F.col("bin") + 1) * width).alias("bin_end"), "n")
    )


def within_last(df: DataFrame, ts: str, seconds: int, as_of: datetime | str | Column | None, inclusive: bool = False) -> DataFrame:
    """Rows newer than ``as_of - seconds`` (the cutoff itself only when ``inclusive``)."""
    cutoff = shift(clock(as_of), "SECOND", -seconds)
    return df.filter(F.col(ts) >= cutoff if inclusive else F.col(ts) > cutoff)


def trailing_stats(
    df: DataFrame, *, ts: str, succeeded: Column, latency: str, seconds: int = 30,
    as_of: datetime | str | Column | None = None, components: tuple[str, ...] = (),
) -> DataFrame:
    """One row for the trailing window: rates, latency of successes, mean of non-zero component times."""
    recent = within_last(df, ts, seconds, as_of).withColumn("_ok", succeeded)
    good = F.col("_ok")
    # A NULL or zero component time means "not measured" and stays out of its mean.
    parts = [
        F.coalesce(exact_avg(F.when(good & (F.col(c) != 0), F.col(c))), F.lit(0.0)).alias(f"avg_{c}")
        for c in components
    ]
    rates = recent.groupBy().agg(
        F.count("*").alias("total"), F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"),
        ratio(F.count_if(good) * 100, F.count("*")).alias("success_rate"),
        (F.count("*") / F.lit(float(seconds))).alias("throughput"),
        F.coalesce(exact_avg(F.when(good, F.col(latency))), F.lit(0.0)).alias("avg_latency"), *parts)
    tails = nearest_rank_percentiles(recent.filter("_ok"), [], latency, {"p95_latency": 95, "p99_latency": 99})
    tails = tails.agg(F.struct(F.max("p95_latency").alias("p95_latency"), F.max("p99_latency").alias("p99_latency"))).scalar()
    return rates.select(
        "*", *[F.coalesce(tails[c], F.lit(0.0)).alias(c) for c in ("p95_latency", "p99_latency")])


def sliding_window_stats(
    df: DataFrame, *, ts: str, succeeded: Column, latency: str, by: tuple[str, ...] = (),
    window_seconds: int = 30, slide_seconds: int = 1,
) -> DataFrame:
    """Stats of every window of ``window_seconds`` that starts on a ``slide_seconds`` tick, with exact p95 and p99.

    Rows are first summed per tick; only the tick sums are copied into the windows that cover them.
    Latencies are those of successes; a window without any has NULL for them.
    """
    tick = df.groupBy(*by, F.window(ts, f"{slide_seconds} seconds")["start"].alias("_tick")).agg(
        F.count("*").alias("_n"), F.count_if(succeeded).alias("_ok"),
        F.sum(F.when(succeeded, exact(latency, 6))).alias("_sum"),
        F.max(F.when(succeeded, F.col(latency))).alias("_max"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(window_seconds - slide_seconds), F.lit(slide_seconds)))
    spread = tick.select("*", steps.alias("_step")).withColumn(
        "window_start", F.timestamp_add("SECOND", -F.col("_step"), F.col("_tick")))
    ok = F.sum("_ok")
    stats = spread.groupBy(*by, "window_start").agg(
        F.sum("_n").alias("total"), ok.alias("successful"),
        ratio(ok * 100, F.sum("_n")).alias("success_rate"),
        ratio(F.sum("_sum").cast("double"), ok, None).alias("avg_latency"), F.max("_max").alias("max_latency"),
    ).withColumn("window_end", F.timestamp_add("SECOND", F.lit(window_seconds), F.col("window_start")))
    tails = window_tails(df.filter(succeeded), ts=ts, value=latency, by=by, window_seconds=window_seconds, slide_seconds=slide_seconds)
    tails = tails.select(group_key(list(by)).alias("_group"), "window_start", *TAILS)
    return stats.withColumn("_group", group_key(list(by))).join(tails, ["_group", "window_start"], "left").drop("_group")


def regression_metrics(df: DataFrame, by: list[str], label: str, prediction: str) -> DataFrame:
    """RMSE and MAE (2 decimals) and R2 (4 decimals) per group, in one aggregate."""
    # Pairs with a missing side have a NULL error and drop out of every aggregate. (A filter would
    # make Spark compute the prediction twice: once to test it, once to use it.)
    error = F.col(label) - F.col(prediction)
    y = F.when(error.isNotNull(), F.col(label))
    return df.groupBy(*by).agg(
        F.count(error).alias("n"),
        rounded(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        rounded(F.avg(F.abs(error)), 2).alias("mae"),
        rounded(F.lit(1.0) - F.try_divide(F.sum(error * error), F.count(error) * F.var_pop(y)), 4).alias("r2"))
