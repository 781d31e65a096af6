"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan from real sizes: joins pick broadcast only for sides measured small, skewed join
    # partitions split, small shuffle partitions merge.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods over 8000 bytes. Wide projections (22 sanitised inputs, 22
    # scaled features) are faster as several small methods than as one fused large one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Zone-free timestamps are used throughout; this keeps display and streaming event time on UTC.
    "spark.sql.session.timeZone": "UTC",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with the library's settings; anything set later wins."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def small_methods(spark: SparkSession) -> None:
    """Gives a session that was built without ``tuned`` the limit on generated methods, unless it has one of its own.

    Methods over that size are interpreted, not compiled: reading the log's JSON took three times as long.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":  # Spark's default
        spark.conf.set(name, SETTINGS[name])
