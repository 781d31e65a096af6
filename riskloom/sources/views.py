"""Customers, policies, requests and logs derived from the star-schema test tables.

All formulas are integer arithmetic on the table keys, so any SQL engine derives the same rows.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom import fixed_values as fv
from riskloom.functions.numeric import rounded
from riskloom.functions.rating import annual_premium, car_age, car_value

YEAR = 2026


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per session."""
    path = os.path.join(folder, f"{name}.parquet")
    return spark.read.schema(_schema(spark, path)).parquet(path)


def one_of(values: list, index: str) -> str:
    """SQL for the element of a constant list at a 0-based index."""
    items = ", ".join(f"'{x}'" if isinstance(x, str) else f"{x}D" if isinstance(x, float) else f"{x}L" for x in values)
    return f"element_at(array({items}), CAST({index} + 1 AS INT))"


def padded(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS STRING), greatest({width}, length(CAST({number} AS STRING))), '0')"


def people(source: DataFrame, key: str, region: str) -> DataFrame:
    """Customer attributes for every row of a keyed table."""
    return source.selectExpr(f"CAST({key} AS BIGINT) AS k", f"CAST({region} AS BIGINT) AS r").selectExpr(
        f"{padded('CUST_', 'k', 6)} AS customer_id",
        f"{one_of(fv.FIRST_NAMES, 'k % 16')} AS first_name",
        f"{one_of(fv.LAST_NAMES, '(k div 16) % 16')} AS last_name",
        "18 + (k * 7) % 63 AS age",
        "CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "greatest(1, least(2 + (k * 7) % 63, (k * 13) % 45)) AS years_licensed",
        "(k * 5) % 7 AS claims_history",
        "300 + (k * 37) % 551 AS credit_score",
        f"{one_of(fv.STATES, 'r % 10')} AS state")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return people(table(spark, folder, "customer"), "c_custkey", "c_nationkey")


def prospects(spark: SparkSession, folder: str) -> DataFrame:
    """One person per part; keys beyond the customer table have no policies."""
    return people(table(spark, folder, "part"), "p_partkey", "p_size")


def vehicle_columns(o: str) -> list[str]:
    make = one_of(list(fv.CAR_MAKES), f"{o} % 8")
    return [
        f"{make} AS car_make",
        f"{make} || '-' || CAST(({o} div 8) % 5 AS STRING) AS car_model",
        f"2010 + {o} % 16 AS car_year",
        f"1000 + ({o} * 97) % 240000 AS kilometers",
        f"{one_of(fv.ENGINE_SIZES, f'({o} div 2) % 9')} AS engine_size",
        f"CASE WHEN {o} % 8 = 6 THEN 'Electric' ELSE {one_of(fv.FUEL_TYPES, f'({o} div 3) % 4')} END AS fuel_type",
        f"{one_of(fv.TRANSMISSIONS, f'({o} div 5) % 3')} AS transmission",
        f"{one_of(fv.COVERAGE_TYPES, f'({o} div 7) % 4')} AS coverage_type",
    ]


def vehicles(spark: SparkSession, folder: str) -> DataFrame:
    """Policies without the label: one per order."""
    base = table(spark, folder, "orders").selectExpr(
        f"{padded('POL_', 'o_orderkey', 7)} AS policy_id",
        f"{padded('CUST_', 'o_custkey', 6)} AS customer_id",
        *vehicle_columns("o_orderkey"),
        f"{one_of(fv.DEDUCTIBLES, '(o_orderkey div 11) % 5')} AS deductible",
        "o_orderdate AS updated_at")
    value = car_value("car_make", car_age("car_year", YEAR), "kilometers")
    return base.withColumn("estimated_car_value", rounded(value, 2))


def policies(spark: SparkSession, folder: str) -> DataFrame:
    """One policy per order, priced with the noise-free rating formula."""
    owners = customers(spark, folder).select(
        "customer_id", "age", "years_licensed", "claims_history", "credit_score")
    premium = annual_premium(
        "age", "years_licensed", "claims_history", "credit_score",
        "car_make", "estimated_car_value", "coverage_type", "deductible")
    return (
        vehicles(spark, folder).join(owners, "customer_id")
        .withColumn("annual_premium", rounded(premium, 2))
        .drop("age", "years_licensed", "claims_history", "credit_score")
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Quote requests, one per line item: keyed by part, so some ids are unknown; some have none."""
    value = car_value("car_make", F.col("car_age"), F.col("kilometers"))
    return (
        table(spark, folder, "lineitem")
        .selectExpr("l_orderkey * 10 + l_linenumber AS l", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
        .selectExpr(
            "l AS request_id",
            f"CASE WHEN l_returnflag <> 'A' THEN {padded('CUST_', 'l_partkey', 6)} END AS customer_id",
            "l_shipdate AS ts",
            *vehicle_columns("l"),
            "18 + (l * 7) % 63 AS age",
            "greatest(1, least(2 + (l * 7) % 63, (l * 13) % 45)) AS years_licensed",
            "CASE WHEN l % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
            f"{one_of(fv.STATES, 'l_suppkey % 10')} AS state")
        .selectExpr("* EXCEPT (car_year)", f"{YEAR} - car_year AS car_age")
        .withColumn("estimated_car_value", rounded(value, 2))
    )
