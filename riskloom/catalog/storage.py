"""Tables written and read back: defaults, overwrite by name, registry and alert tables, frozen datasets, calls by name."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from riskloom import fixed_values as fv
from riskloom.catalog import Query
from riskloom.catalog import modelling
from riskloom.catalog import operations as ops
from riskloom.catalog import relational as rel
from riskloom.catalog import sql as q
from riskloom.plans import features as pf
from riskloom.plans import incremental, registry
from riskloom.schemas import ALERTS, MODEL_EVENTS
from riskloom.sources import tables, views as v
from riskloom.sources.scratch import new_folder
from riskloom.streaming import increment

NOTES = StructType([
    StructField("event_id", LongType()), StructField("kind", StringType()),
    tables.with_default("state", StringType(), "'open'"), tables.with_default("noted_at", TimestampNTZType(), f"TIMESTAMP_NTZ '{q.AS_OF}'")])


def append_defaults(spark, d):
    """A table whose defaults are kept with it: rows come without them, then with one, then as a single bound row."""
    path = new_folder(spark, "notes")
    tables.ensure_table(spark, path, NOTES)
    events = v.table(spark, d, "events").select("event_id", F.col("event_type").alias("kind"), "ts")
    tables.append(events.filter("kind != 'error'").select("kind", "event_id"), path)
    tables.append(events.filter("kind = 'error'").select("event_id", "kind", F.lit("failed").alias("state")), path)
    tables.insert_row(spark, path, spark.read.parquet(path).schema, kind="end")
    return tables.read_table(spark, path)


def table_overwrite(spark, d):
    """A catalog table written by name, replaced, and read back by name."""
    name = f"riskloom_{uuid.uuid4().hex}"
    orders = v.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.overwrite(orders.filter("o_totalprice < 0"), name)
    tables.overwrite(orders, name)
    return tables.read_table(spark, name)


def registry_table(spark, d):
    """The registry's state from its event table on disk."""
    folder = new_folder(spark, "registry")
    models = registry.Registry(spark, folder)
    tables.append(ops.model_events(spark, d), folder, MODEL_EVENTS)
    return models.versions().select("model", "version", "created_on", F.col("metrics")[fv.GATE_METRIC].alias("test_r2"), "is_default")


def quality_alerts(spark, d):
    """An alert row for every candidate the gate turns down."""
    path = new_folder(spark, "alerts")
    tables.ensure_table(spark, path, ALERTS)
    failed = ops.quality_gate(spark, d).filter(F.col("decision") == fv.ALERT)
    tables.append(failed.select(F.lit(q.AS_OF).alias("alert_time"), F.lit(fv.ALERT_TYPE).alias("alert_type"),
                                F.concat_ws(" ", "model", "version").alias("message")), path)
    return spark.read.parquet(path)


def dataset_listing(spark, d):
    """Datasets frozen per market segment, as listed and counted."""
    root = new_folder(spark, "datasets")
    segments = v.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    for r in range(3):
        tables.write_dataset(segments.filter(F.col("c_custkey") % 3 == r), root, "segments", f"v{r}")
    parts = [tables.read_dataset(spark, root, "segments", f"v{r}").select(F.lit(f"v{r}").alias("dataset_version")) for r in range(3)]
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("dataset_version").agg(F.count("*").alias("row_count"))
    return tables.list_datasets(spark, root).drop("row_count").join(counted, "dataset_version").select("dataset_name", "dataset_version", "row_count")


def dispatch_by_name(spark, d):
    """Both functions of the saved model called by their name; whether each row is what the function itself gives."""
    model, inputs, key = modelling.saved_model(spark, d), rel.inference_input(spark, d), ("policy_id",)
    parts = []
    for name, direct in (("predict", model.predict(inputs, key)), ("transform", model.transform(inputs, key))):
        values = F.struct(*[c for c in direct.columns if c not in key])
        called = model.run(inputs, name, key).select(*key, values.alias("called"))
        both = called.join(direct.select(*key, values.alias("direct")), *key)
        parts.append(both.select(*key, F.lit(name).alias("function_name"), (F.col("called") == F.col("direct")).alias("agrees")))
    return parts[0].unionByName(parts[1])


def incremental_features(spark, d):
    """The feature view after a first load and one refresh by changes: policies come, change and go. Only customers
    that the changes touch are computed anew; the others keep the rows of the first load."""
    number = F.substring("policy_id", 5, 20).cast("bigint")
    rows = v.vehicles(spark, d).withColumn("_k", number)
    customers = v.customers(spark, d)
    sums = incremental.FeatureSums(spark, new_folder(spark, "sums"))
    sums.apply(incremental.changes(added=rows.filter("_k % 4 != 0")), "load")
    path = new_folder(spark, "feature-history")
    pf.refresh_table(path, sums.features(customers, year=v.YEAR, as_of="2024-01-01 00:00:00"), as_of=datetime(2024, 1, 1))
    old = rows.filter("_k % 4 != 0 AND (_k % 5 = 0 OR _k % 7 = 0)")
    new = rows.filter("_k % 7 != 0 AND (_k % 4 = 0 OR _k % 5 = 0)").withColumn("kilometers", F.when(F.col("_k") % 5 == 0, F.col("kilometers") + 500).otherwise(F.col("kilometers")))
    change = incremental.changes(added=new, removed=old)
    touched = sums.apply(change, "first change")
    sums.apply(change, "first change")  # counted once
    pf.refresh_table(path, sums.features(customers, year=v.YEAR, as_of=q.AS_OF, keys=touched), as_of=datetime(2024, 1, 31))
    return pf.current_features(spark, path).drop("updated_at")


def concurrent_state(spark, d):
    """Marks that six jobs set and move at once, each for the event kinds of its own; none of their changes is lost."""
    path = new_folder(spark, "marks")
    increment.Watermarks(spark, path)
    newest = v.table(spark, d, "events").groupBy("event_type").agg(F.max("ts").alias("ts"), F.min("ts").alias("first")).collect()

    def job(row):
        marks = increment.Watermarks(spark, path)
        marks.start(row["event_type"])
        marks.advance(row["first"], row["event_type"])
        marks.advance(row["ts"], row["event_type"], row["first"])

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(job, newest))
    return increment.Watermarks(spark, path).read()


def dataset_manifest(spark, d):
    """A version frozen, tried again, and listed with what its manifest says."""
    root = new_folder(spark, "manifests")
    for name in ("region", "nation"):
        tables.write_dataset(v.table(spark, d, name), root, name, "v1")
        try:
            tables.write_dataset(v.table(spark, d, name).limit(0), root, name, "v1")
        except FileExistsError:
            pass
    problems = sum(len(tables.dataset_problems(spark, root, name, "v1")) for name in ("region", "nation"))
    return tables.list_datasets(spark, root).withColumn("problems", F.lit(problems))


QUERIES: dict[str, Query] = {
    "append_defaults": Query(append_defaults, f"""
SELECT event_id, event_type AS kind, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'open' END AS state, TIMESTAMP '{q.AS_OF}' AS noted_at FROM events
UNION ALL SELECT NULL, 'end', 'open', TIMESTAMP '{q.AS_OF}'"""),
    "table_overwrite": Query(table_overwrite, "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders"),
    "registry_table": Query(registry_table, q.with_("SELECT * FROM state", **ops.STATE)),
    "quality_alerts": Query(quality_alerts, f"""
SELECT TIMESTAMP '{q.AS_OF}' AS alert_time, '{fv.ALERT_TYPE}' AS alert_type, model || ' ' || version AS message
FROM ({ops.QUERIES['quality_gate'].sql}) WHERE decision = '{fv.ALERT}'"""),
    "dataset_listing": Query(dataset_listing, """
SELECT 'segments' AS dataset_name, 'v' || c_custkey % 3 AS dataset_version, count(*) AS row_count FROM customer GROUP BY 2"""),
    "incremental_features": Query(incremental_features, q.with_(
        "SELECT * EXCLUDE (updated_at) FROM features", customers=q.CUSTOMERS, vehicles=q.VEHICLES, moved="""
SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 5 = 0 THEN kilometers + 500 ELSE kilometers END AS kilometers)
FROM (SELECT *, substring(policy_id, 5)::BIGINT AS k FROM vehicles) WHERE k % 7 <> 0""", features=q.features("customers", "moved"))),
    "concurrent_state": Query(concurrent_state, "SELECT event_type AS watermark_key, max(ts) AS last_processed FROM events GROUP BY 1"),
    "dataset_manifest": Query(dataset_manifest, """
SELECT 'region' AS dataset_name, 'v1' AS dataset_version, count(*) AS row_count, 0 AS problems FROM region
UNION ALL SELECT 'nation', 'v1', count(*), 0 FROM nation"""),
    "dispatch_by_name": Query(dispatch_by_name, q.with_(
        "SELECT policy_id, f AS function_name, true AS agrees FROM input, (VALUES ('predict'), ('transform')) t(f)", **q.FEATURED, input=q.MODEL_INPUT)),
}
