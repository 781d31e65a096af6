"""The feature view kept up to date by signed changes, without going back to the policies.

Everything the view says about a customer's policies follows from sums and counts, and those of a
change are added (a new row) or taken back (an old one). A change is summed per customer and kept as
a part of its own; the state is the sum over the parts. Sums are fixed-point, so that what is taken
back leaves nothing behind.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions.numeric import exact, rounded
from riskloom.plans.features import risk_features
from riskloom.sources import tables

SIGN = "_sign"
AVERAGED = ("car_year", "kilometers", "deductible")
VALUE = "estimated_car_value"
PARTS = StructType([StructField("change_id", StringType()), StructField("folder", StringType())])
SCALE = {c: 6 for c in AVERAGED} | {VALUE: 2}
SUMS = ["policies", *[f"{kind}_{c}" for c in SCALE for kind in ("n", "sum")]]


def changes(*, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Signed policy rows: ``added`` are new ones and the new images of updates, ``removed`` deleted ones and the old images."""
    parts = [df.withColumn(SIGN, F.lit(sign)) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def summed(signed: DataFrame) -> DataFrame:
    """Signed rows as sums and counts per customer; customers whose changes cancel out have zeros."""
    sign = F.col(SIGN)
    return signed.groupBy("customer_id").agg(
        F.sum(F.when(F.col("policy_id").isNotNull(), sign).otherwise(0)).cast("bigint").alias("policies"),
        *[a for c, scale in SCALE.items() for a in (
            F.sum(F.when(exact(c, scale).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"n_{c}"),
            F.coalesce(F.sum(exact(c, scale) * sign), F.lit(0)).cast(f"decimal(38,{scale})").alias(f"sum_{c}"))])


def _added(parts: DataFrame) -> DataFrame:
    scales = {f"sum_{c}": scale for c, scale in SCALE.items()}
    return parts.groupBy("customer_id").agg(*[
        (F.sum(c).cast(f"decimal(38,{scales[c]})") if c in scales else F.sum(c)).alias(c) for c in SUMS])


def history(sums: DataFrame, *, year: int) -> DataFrame:
    """The view's policy columns from sums and counts; customers without a policy have no row."""
    def mean(c: str, total: Column | None = None) -> Column:
        return F.try_divide((F.col(f"sum_{c}") if total is None else total).cast("double"), F.col(f"n_{c}"))

    age = F.lit(year) * F.col("n_car_year") - F.col("sum_car_year")
    return sums.filter("policies > 0").select(
        "customer_id", F.col("policies").alias("total_policies"), rounded(mean("car_year", age), 2).alias("avg_car_age"),
        rounded(mean("kilometers"), 0).alias("avg_kilometers"),
        F.when(F.col(f"n_{VALUE}") > 0, F.col(f"sum_{VALUE}").cast("double")).alias("total_car_value"),
        rounded(mean("deductible"), 0).alias("avg_deductible"))


class FeatureSums:
    """Sums per customer at a path, kept as parts. Each change has an id and counts once, however often it is
    applied and by however many jobs: its part is written first, and listing it is what makes it count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.parts = tables.StateTable(spark, f"{self.path}/parts", PARTS)

    def apply(self, signed: DataFrame, change_id: str) -> DataFrame:
        """Count a change (the first one holds all policies) and return the customers it touches."""
        listed = self.parts.read().filter(F.col("change_id") == change_id).first()
        if listed is None:
            folder = f"{self.path}/data/{uuid.uuid4().hex}"
            summed(signed).write.parquet(folder)
            row = self.spark.createDataFrame([(change_id, folder)], PARTS)
            self.parts.update(lambda now: tables.insert_absent(now, row, ["change_id"]))
            listed = self.parts.read().filter(F.col("change_id") == change_id).first()
            if listed["folder"] != folder:  # another job has counted this change meanwhile
                tables.remove(self.spark, folder)
        return self.spark.read.parquet(listed["folder"]).select("customer_id")

    def sums(self, keys: DataFrame | None = None) -> DataFrame:
        """The state, of all customers or of those in ``keys``. Parts of one customer meet in partial sums."""
        folders = sorted({r["folder"] for r in self.parts.read().select("folder").distinct().collect()})
        if not folders:
            raise ValueError("no change has been applied yet")
        rows = self.spark.read.parquet(*folders)
        rows = rows if keys is None else rows.join(keys.distinct(), "customer_id", "left_semi")
        return _added(rows)

    def features(self, customers: DataFrame, *, year: int, as_of: datetime | str | Column | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The feature view of all customers, or of those in ``keys``: what a refresh has to write anew."""
        if keys is not None:
            customers = customers.join(keys.distinct(), "customer_id", "left_semi")
        return risk_features(customers, history(self.sums(keys), year=year), as_of=as_of)

    def compact(self) -> int:
        """Fold all parts into one; returns how many there were. Ids stay known, so an old change is still not counted twice.

        A change listed meanwhile keeps its part, since only the folded ones are renamed. Old parts stay for readers until `drop_unlisted`."""
        before = self.parts.read()
        folders = [r["folder"] for r in before.select("folder").distinct().collect()]
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows = _added(self.spark.read.parquet(*folders))
        rows.filter(" OR ".join(f"{c} != 0" for c in SUMS)).write.parquet(folder)
        folded = F.col("folder").isin(folders)
        self.parts.update(lambda now: now.select("change_id", F.when(folded, F.lit(folder)).otherwise(F.col("folder")).alias("folder")))
        return len(folders)

    def drop_unlisted(self) -> int:
        """Remove the folders that no change names any more; returns how many."""
        listed = {r["folder"].rsplit("/", 1)[1] for r in self.parts.read().select("folder").distinct().collect()}
        gone = [n for n in tables.names(self.spark, f"{self.path}/data") if n not in listed]
        for name in gone:
            tables.remove(self.spark, f"{self.path}/data/{name}")
        return len(gone)
