"""Model versions as an append-only event table: register, promote, gate, expire, list, alert.

The state is a query over the events; nothing is updated in place.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.functions.times import clock, format_time, shift
from riskloom.schemas import ALERTS, MODEL_EVENTS
from riskloom.sources import tables


def version_name(at: datetime | str | Column | None = None) -> Column:
    """'v_20240131_235959'."""
    return format_time(clock(at), fv.VERSION_FORMAT)


# --- state as queries over the events -------------------------------------------------------------

def newest_metrics(events: DataFrame) -> DataFrame:
    """(model, version, metrics): of every metric the newest value. Metrics may be set one by one;
    those of the registration are older than others of the same time."""
    at = F.struct("event_ts", F.when(F.col("event") == "register", 0).otherwise(1).alias("_order"))
    each = events.select("model", "version", at.alias("_at"), F.explode("metrics").alias("_name", "_value"))
    newest = each.groupBy("model", "version", "_name").agg(F.max_by("_value", "_at").alias("_value"))
    return newest.groupBy("model", "version").agg(F.map_from_entries(F.collect_list(F.struct("_name", "_value"))).alias("metrics"))


def version_state(events: DataFrame) -> DataFrame:
    """One row per live version: created_on, newest value of every metric, artifact path, comment, is_default."""
    kind = F.col("event")
    versions = events.groupBy("model", "version").agg(
        F.min(F.when(kind == "register", F.col("event_ts"))).alias("created_on"),
        F.max_by("artifact_path", F.when(F.col("artifact_path").isNotNull(), F.col("event_ts"))).alias("artifact_path"),
        F.max_by("comment", F.when(F.col("comment").isNotNull(), F.col("event_ts"))).alias("comment"),
        F.bool_or(kind == "delete").alias("_deleted"))
    live = versions.filter(F.col("created_on").isNotNull() & ~F.col("_deleted")).drop("_deleted")
    live = live.join(newest_metrics(events), ["model", "version"], "left").select(
        "model", "version", "created_on", "metrics", "artifact_path", "comment")
    defaults = current_default(events).select("model", F.col("version").alias("_default"))
    return live.join(defaults, "model", "left").withColumn(
        "is_default", F.coalesce(F.col("version") == F.col("_default"), F.lit(False))).drop("_default")


def current_default(events: DataFrame) -> DataFrame:
    """(model, version, promoted_at): the version promoted last. No row for a model never promoted."""
    promoted = events.filter(F.col("event") == "promote")
    return promoted.groupBy("model").agg(
        F.max_by("version", F.struct("event_ts", "version")).alias("version"), F.max("event_ts").alias("promoted_at"))


def gate_decisions(
    candidates: DataFrame, events: DataFrame, *, metric: str = fv.GATE_METRIC, threshold: float = fv.GATE_THRESHOLD,
) -> DataFrame:
    """``decision`` per candidate (model, version, score): promote when there is no production
    version, or when the score reaches both the threshold and production's score. A score that is
    unknown or not a number counts as 0 on either side."""
    known = lambda c: F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(0.0))
    production = version_state(events).filter("is_default").select(
        "model", F.col("version").alias("production_version"),
        known(F.try_element_at("metrics", F.lit(metric)).cast("double")).alias("production_score"))
    score = known(F.col("score").cast("double"))
    good = (score >= threshold) & (score >= F.col("production_score"))
    return candidates.join(production, "model", "left").withColumn(
        "decision",
        F.when(F.col("production_version").isNull() | good, fv.PROMOTE).otherwise(fv.ALERT))


def expired_versions(events: DataFrame, *, as_of=None, days: int = fv.EXPIRY_DAYS) -> DataFrame:
    """Live versions created before ``as_of - days``, the default ones excepted. A model without a
    default keeps all its versions."""
    cutoff = shift(clock(as_of), "DAY", -days)
    with_default = current_default(events).select("model")
    return (
        version_state(events).filter((F.col("created_on") < cutoff) & ~F.col("is_default"))
        .join(with_default, "model", "left_semi").select("model", "version", "created_on", "artifact_path"))


# --- the table ------------------------------------------------------------------------------------

class Registry:
    """The event table at a path, for one or more models."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        tables.ensure_table(spark, path, MODEL_EVENTS)

    def events(self) -> DataFrame:
        return self.spark.read.schema(MODEL_EVENTS).parquet(self.path)

    def record(self, model: str, version: str, event: str, *, metrics: dict[str, float] | None = None,
               artifact_path: str | None = None, comment: str | None = None, at=None) -> None:
        measured = F.lit(None) if not metrics else F.create_map(
            *[F.lit(x) for k, v in metrics.items() for x in (k, float(v))])
        tables.insert_row(
            self.spark, self.path, MODEL_EVENTS, model=model, version=version, event=event, metrics=measured,
            artifact_path=artifact_path, comment=comment, event_ts=clock(at))

    def register(self, model: str, version: str, metrics: dict[str, float], *, artifact_path=None, comment=None, at=None) -> None:
        if not self.version(model, version).isEmpty():
            raise ValueError(f"{model} {version} is registered already")
        self.record(model, version, "register", metrics=metrics, artifact_path=artifact_path, comment=comment, at=at)

    def set_metrics(self, model: str, version: str, metrics: dict[str, float], at=None) -> None:
        """Sets these metrics of a version; its others stay."""
        self.record(model, version, "metric", metrics=metrics, at=at)

    def promote(self, model: str, version: str, at=None) -> None:
        if self.version(model, version).isEmpty():
            raise ValueError(f"{model} {version} is not registered")
        self.record(model, version, "promote", at=at)

    def versions(self) -> DataFrame:
        return version_state(self.events())

    def version(self, model: str, version: str) -> DataFrame:
        return self.versions().filter((F.col("model") == model) & (F.col("version") == version))

    def default(self, model: str) -> dict | None:
        row = self.versions().filter((F.col("model") == model) & F.col("is_default")).first()
        return row.asDict() if row else None

    def check(self, model: str, version: str, metrics: dict[str, float], *, metric: str = fv.GATE_METRIC,
              threshold: float = fv.GATE_THRESHOLD) -> str:
        candidate = self.spark.createDataFrame(
            [(model, version, float(metrics.get(metric, 0.0)))], "model string, version string, score double")
        return gate_decisions(candidate, self.events(), metric=metric, threshold=threshold).first()["decision"]

    def expire(self, *, as_of=None, days: int = fv.EXPIRY_DAYS) -> int:
        """Append delete events for the expired versions, then remove their artifacts; returns how many.

        The events come first: if the job dies in between, a folder is left over, but no version
        points to nothing. Versions are few; their paths are what the driver sees."""
        rows = expired_versions(self.events(), as_of=as_of, days=days).collect()
        count = tables.append(self.spark.createDataFrame(
            [(r["model"], r["version"]) for r in rows], "model string, version string").select(
            "model", "version", F.lit("delete").alias("event"), clock(as_of).alias("event_ts")), self.path, MODEL_EVENTS)
        for r in rows:
            if r["artifact_path"]:
                tables.remove(self.spark, r["artifact_path"])
        return count


def alert_message(version: str, metrics: dict[str, float]) -> str:
    return fv.ALERT_MESSAGE.format(version=version, metrics=json.dumps(metrics))


def send_alert(spark: SparkSession, path: str, version: str, metrics: dict[str, float], at=None) -> str:
    """Append a quality alert to the alert table."""
    tables.ensure_table(spark, path, ALERTS)
    message = alert_message(version, metrics)
    tables.insert_row(spark, path, ALERTS, alert_time=clock(at), alert_type=fv.ALERT_TYPE, message=message)
    return message
