"""Latest row per key, newest N per series, newest N overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each key. An aggregate, so each map task sends at most one row per key."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(ts, *tiebreak))
    picked = df.groupBy(*keys).agg(newest.alias("_newest"))
    return picked.select(*[f"`{c}`" if c in keys else f"_newest.`{c}`" for c in df.columns])


def newest_rows(df: DataFrame, n: int, ts: str, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The newest ``n`` rows, newest first."""
    return df.orderBy(F.desc(ts), *[F.desc(c) for c in tiebreak]).limit(n)


def newest_per_series(df: DataFrame, series: list[str], n: int, ts: str, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The newest ``n`` rows of each series. Spark limits each group before the shuffle as well."""
    order = W.partitionBy(*series).orderBy(F.desc(ts), *[F.desc(c) for c in tiebreak])
    return df.withColumn("row_rank", F.row_number().over(order)).filter(F.col("row_rank") <= n)


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(*keys).limit(n)


def retrieve_latest(spine: DataFrame, features: DataFrame, *, on: str, feature_ts: str, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Spine rows with the newest feature row of their key (no point in time)."""
    return spine.join(latest_per_key(features, [on], feature_ts, tiebreak), on, "left")
