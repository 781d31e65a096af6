"""Observability of scoring: log listing, latencies, request analytics, run history, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.functions.numeric import text_or
from riskloom.functions.text import money_text, whole_text
from riskloom.functions.times import format_time, millis_between
from riskloom.operators.latest import newest_rows
from riskloom.operators.statistics import (
    category_counts, error_frequency, latency_stats, status_rates, within_last,
)
from riskloom.sources.serving_log import DEFAULT_PREFIX, extract, object_of


def log_listing(log: DataFrame, n: int = 20, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """The newest log records with ids, function, the inputs as one JSON object, the prediction."""
    newest = newest_rows(log, n, "timestamp", ("resource_attributes",))
    inputs = object_of(**{c.upper(): F.col(c) for c in fv.MODEL_INPUT_COLS})
    return extract(newest, prefix).select(
        "timestamp", "query_id", "service_name", "function_name", inputs.alias("input_data"), fv.PREDICTION_COL)


def log_latencies(log: DataFrame, *, seconds: int, as_of=None, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Request-to-response milliseconds of the records of the last ``seconds``."""
    return extract(within_last(log, "timestamp", seconds, as_of, inclusive=True), prefix, inputs=[]).select(
        "timestamp", "query_id", "service_name", "request_timestamp", "response_timestamp",
        millis_between("request_timestamp", "response_timestamp").alias("inference_latency_ms"))


def latency_panel(latencies: DataFrame) -> DataFrame:
    """Latency statistics per call plus the service name of the newest record."""
    service = latencies.agg(F.max_by("service_name", F.struct("timestamp", "query_id")).alias("s")).scalar()
    return latency_stats(latencies, [], "inference_latency_ms", "query_id").withColumn(
        "service_name", F.coalesce(service, F.lit("Unknown")))


def latency_preview(latencies: DataFrame, n: int = 100) -> DataFrame:
    return newest_rows(latencies, n, "timestamp", ("query_id",)).select("timestamp", "query_id", "inference_latency_ms")


def request_totals(results: DataFrame, by: list[str], seconds: Column | float) -> DataFrame:
    return status_rates(results, by, F.col("status") == "success", seconds)


def customer_type_counts(results: DataFrame) -> DataFrame:
    return category_counts(results, F.col("status") == "success", "customer_type")


def failures(results: DataFrame) -> DataFrame:
    return error_frequency(results.filter(F.col("status") == "error"), "error")


def recent_predictions(results: DataFrame, n: int = 10) -> DataFrame:
    """Display rows of the newest successes."""
    newest = newest_rows(results.filter(F.col("status") == "success"), n, "timestamp", ("request_id",))
    return newest.select(
        F.col("request_id"),
        format_time("timestamp", fv.TIME_FORMAT).alias("time"),
        text_or("customer_id", fv.NEW_CUSTOMER_TEXT).alias("customer"),
        F.coalesce("customer_type", F.lit("")).alias("type"),
        F.concat_ws(" ", "car_make", "car_model").alias("car"),
        money_text(fv.PREDICTION_COL).alias("premium"),
        whole_text("latency_ms").alias("total_ms"),
        whole_text(F.coalesce("feature_store_ms", F.lit(0.0))).alias("feature_ms"),
        whole_text(F.coalesce("model_inference_ms", F.lit(0.0))).alias("model_ms"))


def run_history(runs: DataFrame, *, name: str | None = None, seconds: int = 3600, n: int = 10, as_of=None) -> DataFrame:
    """The newest runs scheduled within the last ``seconds``."""
    recent = within_last(runs, "scheduled_time", seconds, as_of, inclusive=True)
    if name is not None:
        recent = recent.filter(F.col("name") == name)
    return newest_rows(recent, n, "scheduled_time", ("name",)).select(
        "name", "state", "scheduled_time", "completed_time", "error_message")


def alerts_newest_first(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("alert_time"), "message")
