"""The as-of join reads and shuffles each side once."""

from pyspark.sql import functions as F

from riskloom.operators.asof import asof_join


def test_one_shuffle_and_two_scans(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    right = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("right_ts"), F.col("event_id").alias("right_id"))
    joined = asof_join(events.filter("event_type = 'purchase'"), right, on=["user_id"], left_ts="ts", right_ts="right_ts")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final
    # Two scans feed the shuffle; rows without a key or time are read apart.
    assert final.count("Scan parquet") <= 3


def test_rows_without_key_or_time_come_back(spark):
    left = spark.createDataFrame([(1, 5), (None, 5), (1, None)], "k int, at int").select("k", F.timestamp_seconds("at").cast("timestamp_ntz").alias("ts"))
    right = spark.createDataFrame([(1, 3, "x"), (None, 3, "y"), (1, None, "z")], "k int, at int, v string").select(
        "k", F.timestamp_seconds("at").cast("timestamp_ntz").alias("rts"), "v")
    got = sorted((r.k, r.ts is None, r.v) for r in asof_join(left, right, on=["k"], left_ts="ts", right_ts="rts").collect() if r.k)
    assert got == [(1, False, "x"), (1, True, None)]
    assert asof_join(left, right, on=["k"], left_ts="ts", right_ts="rts").count() == 3
