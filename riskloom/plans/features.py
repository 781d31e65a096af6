"""Feature plans: the per-customer feature view, training spine, model input, training set, refresh."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.fixed_values import LABEL_COL, MODEL_INPUT_COLS
from riskloom.functions import rating
from riskloom.functions.numeric import exact_sum, rounded
from riskloom.functions.times import clock
from riskloom.operators.asof import asof_join
from riskloom.operators.latest import latest_per_key, retrieve_latest
from riskloom.sources.tables import overwrite

HISTORY_COLS = [
    "risk_score", "avg_claims_per_year", "total_policies", "avg_car_age", "avg_kilometers",
    "total_car_value", "avg_deductible",
]


def policy_history(policies: DataFrame, *, year: int) -> DataFrame:
    """Per-customer policy aggregates. Aggregated before any join: map-side partial sums keep a
    customer that owns a large share of all policies from travelling as rows."""
    return policies.groupBy("customer_id").agg(
        F.count("policy_id").alias("total_policies"),
        rounded(F.avg(rating.car_age("car_year", year)), 2).alias("avg_car_age"),
        rounded(F.avg("kilometers"), 0).alias("avg_kilometers"),
        exact_sum("estimated_car_value").alias("total_car_value"),
        rounded(F.avg("deductible"), 0).alias("avg_deductible"),
    )


def customer_risk_features(
    customers: DataFrame, policies: DataFrame, *, year: int, as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """The feature view: one row per customer (``customer_id`` is unique in ``customers``), policies
    optional. Customers without policies count 0 and have NULL averages."""
    return risk_features(customers, policy_history(policies, year=year), as_of=as_of)


def risk_features(customers: DataFrame, history: DataFrame, *, as_of: datetime | str | Column | None = None) -> DataFrame:
    """The feature view from customers and their policy aggregates."""
    people = customers.select("customer_id", "age", "years_licensed", "claims_history", "credit_score")
    return people.join(history, "customer_id", "left").select(
        "customer_id", "age", "years_licensed", "claims_history", "credit_score",
        rating.risk_score("age", "years_licensed", "claims_history", "credit_score").alias("risk_score"),
        rating.claims_per_year("claims_history", "years_licensed").alias("avg_claims_per_year"),
        rating.credit_tier("credit_score").alias("credit_tier"),
        F.coalesce("total_policies", F.lit(0).cast("bigint")).alias("total_policies"),
        "avg_car_age", "avg_kilometers", "total_car_value", "avg_deductible",
        clock(as_of).alias("updated_at"),
    )


def training_spine(policies: DataFrame, customers: DataFrame, *, year: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Policies with their owner's gender and state, car age, label and event time ``ts``."""
    owners = customers.select("customer_id", "gender", "state")
    return policies.join(owners, "customer_id").select(
        *keep, "customer_id", "car_make", "car_model", rating.car_age("car_year", year).alias("car_age"),
        "kilometers", "engine_size", "fuel_type", "transmission", "coverage_type",
        "estimated_car_value", "gender", "state", LABEL_COL,
        F.col("updated_at").try_cast("timestamp_ntz").alias("ts"),
    )


def inference_input(
    policies: DataFrame, customers: DataFrame, features: DataFrame, *, year: int, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Policies joined to their owner and the owner's features; exactly the model columns, in order
    (after any ``keep`` columns). The two per-customer sides join first, so policies shuffle once."""
    owners = customers.select(
        "customer_id", "age", "gender", "state", "years_licensed", "claims_history", "credit_score",
    ).join(features.select("customer_id", *HISTORY_COLS), "customer_id")
    return (
        policies.join(owners, "customer_id")
        .withColumn("car_age", rating.car_age("car_year", year))
        .select(*keep, *MODEL_INPUT_COLS)
    )


def enriched_spine(spine: DataFrame, features: DataFrame, **asof_options) -> DataFrame:
    """Spine rows with the customer's feature row as of their ``ts`` (NULLs where there is none yet)."""
    return asof_join(
        spine, features.withColumnRenamed("updated_at", "feature_ts"),
        on=["customer_id"], left_ts="ts", right_ts="feature_ts", **asof_options)


def labelled_spine(spine: DataFrame, features: DataFrame) -> DataFrame:
    """Spine rows with the customer's newest feature row, whatever its time: what is known today, not
    what was known then. For point-in-time training sets keep a feature history and use ``enriched_spine``."""
    newest = features.withColumnRenamed("updated_at", "feature_ts")
    return retrieve_latest(spine, newest, on="customer_id", feature_ts="feature_ts")


def changed_keys(policies: DataFrame, customers_changed: DataFrame | None, *, since: datetime | str | Column) -> DataFrame:
    """Customers whose policies (or own rows) changed after the last refresh."""
    keys = policies.filter(F.col("updated_at") > clock(since)).select("customer_id")
    if customers_changed is not None:
        keys = keys.unionByName(customers_changed.select("customer_id"))
    return keys.distinct()


def refreshed_features(
    customers: DataFrame, policies: DataFrame, *, since: datetime | str | Column, year: int,
    as_of: datetime | str | Column | None = None, customers_changed: DataFrame | None = None,
) -> DataFrame:
    """Feature rows of the customers touched since the last refresh, recomputed over all their policies."""
    keys = changed_keys(policies, customers_changed, since=since)
    return customer_risk_features(
        customers.join(keys, "customer_id", "left_semi"),
        policies.join(keys, "customer_id", "left_semi"),
        year=year, as_of=as_of)


def refresh_table(path: str, rows: DataFrame, *, as_of: datetime) -> int:
    """Add a refresh to the feature history: one folder per refresh time, replaced when a refresh is
    repeated. The history serves point-in-time joins; its latest rows are the current features."""
    return overwrite(rows, f"{path}/refreshed={as_of:%Y%m%dT%H%M%S}")


def feature_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("refreshed")


def current_features(spark: SparkSession, path: str) -> DataFrame:
    return latest_per_key(feature_history(spark, path), ["customer_id"], "updated_at")
