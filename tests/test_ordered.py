"""As-of joins, positions, order statistics and rolling windows against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from riskloom.functions.times import time_cell
from riskloom.operators import ordered, statistics as st
from riskloom.operators.asof import asof_join
from riskloom.operators.latest import latest_per_key, newest_per_series

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def joined(spark, spine, facts, cell_seconds):
    left = spark.createDataFrame(spine, "i int, k string, ts timestamp_ntz")
    right = spark.createDataFrame(facts, "k string, fts timestamp_ntz, fid int, v double")
    rows = asof_join(left, right, on=["k"], left_ts="ts", right_ts="fts", tiebreak=("fid",), cell_seconds=cell_seconds)
    return {r.i: (r.fid, r.v) for r in rows.collect()}


def brute(spine, facts):
    out = {}
    for i, k, ts in spine:
        found = [f for f in facts if k is not None and ts is not None and f[0] == k and f[1] is not None and f[1] <= ts]
        best = max(found, key=lambda f: (f[1], f[2]), default=None)
        out[i] = (best[2], best[3]) if best else (None, None)
    return out


def test_asof_edges(spark):
    spine = [(0, "a", at(10)), (1, "a", at(9)), (2, "b", at(5)), (3, "a", at(100000)), (4, None, at(10)), (5, "a", None), (6, "c", at(50))]
    facts = [("a", at(10), 1, 1.0), ("a", at(10), 2, 2.0), ("b", at(6), 3, 3.0), ("z", at(0), 4, 4.0), (None, at(0), 5, 5.0),
             ("c", at(40), 6, 6.0), ("c", at(45), 7, None), ("a", None, 8, 8.0)]
    for cell in (1, 7, 3600, 10**7):
        assert joined(spark, spine, facts, cell) == brute(spine, facts)


def test_asof_empty_sides(spark):
    assert joined(spark, [(0, "a", at(0))], [], 60) == {0: (None, None)}
    assert joined(spark, [], [("a", at(0), 1, 1.0)], 60) == {}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=some.integers(0, 10**6), cell=some.sampled_from([3, 20, 500]))
def test_asof_random(spark, seed, cell):
    rng = random.Random(seed)
    key = lambda: rng.choice("aaaaaaab")
    spine = [(i, key(), at(rng.randrange(300))) for i in range(60)]
    facts = [(key(), at(rng.randrange(300)), i, float(i)) for i in range(40)]
    assert joined(spark, spine, facts, cell) == brute(spine, facts)


def test_asof_refuses_clashing_columns(spark):
    df = spark.createDataFrame([("a", at(0))], "k string, ts timestamp_ntz")
    with pytest.raises(ValueError, match="both sides"):
        asof_join(df, df, on=["k"], left_ts="ts", right_ts="ts")


def rank(values, p):
    ordered_values = sorted(values)
    return ordered_values[min(int(len(values) * p / 100), len(values) - 1)]


@pytest.mark.parametrize("n", [1, 2, 20, 100])
def test_nearest_rank(spark, n):
    values = [float((i * 37) % n) ** 3 for i in range(n)]
    df = spark.createDataFrame([("g", x) for x in values], "g string, v double")
    percents = {f"p{p}": p for p in (50, 95, 99, 100)} | {"p975": 97.5}
    got = ordered.nearest_rank_percentiles(df, ["g"], "v", percents).first()
    assert [got[k] for k in percents] == [rank(values, p) for p in percents.values()]


def test_order_statistics_groups_nulls_and_extremes(spark):
    inf = float("inf")
    rows = [(None, 1.0), (None, 3.0), ("a", 5.0), ("a", 5.0), ("a", 5.0), ("b", None), ("b", float("nan")),
            ("c", inf), ("c", -inf), ("c", 0.0), ("d", 1e12), ("d", 1.0), ("d", 1.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.low, r.mid, r.top) for r in ordered.values_at(
        df, ["g"], "v", {"low": F.lit(0), "mid": F.floor(F.col("n") / 2), "top": F.col("n") - 1}).collect()}
    assert got == {None: (2, 1.0, 3.0, 3.0), "a": (3, 5.0, 5.0, 5.0), "c": (3, -inf, 0.0, inf), "d": (3, 1.0, 1.5, 1e12)}


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v double, q string")
    assert ordered.nearest_rank_percentiles(df, ["g"], "v", {"p50": 50}).count() == 0
    one = spark.createDataFrame([("g", None, "")], "g string, v double, q string")
    r = st.latency_stats(one, ["g"], "v", "q").first()
    assert (r.total_inferences, r.avg_latency_ms, r.p95_latency_ms, r.unique_queries) == (1, None, 0.0, 0)


def test_interpolated_quantiles(spark):
    df = spark.createDataFrame([("g", float(x)) for x in (1, 2, 3, 10)], "g string, v double")
    r = ordered.interpolated_quantiles(df, ["g"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}).first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 4.75)


def test_positions_of_one_hot_group(spark):
    rows = [("hot", at(i * 7 % 1000), i) for i in range(1000)] + [("cold", at(5), 2000), (None, at(5), 2001)]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz, i int")
    got = {r.i: (r.position, r.group_rows) for r in ordered.with_position(df, ["g"], ["ts", "i"], time_cell("ts", 60)).collect()}
    order = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))
    assert all(got[r[2]] == (p, 1000) for p, r in enumerate(order))
    assert got[2000] == (0, 1) and got[2001] == (0, 1)


def test_dense_codes_sort_by_code_point(spark):
    values = ["b", "B", "é", "a", "Zz", "ab", "aa", "", "None"]
    df = spark.createDataFrame([("c", x) for x in values], "column string, value string")
    got = {r.value: r.code for r in ordered.dense_codes(df, ["column"], "value").collect()}
    assert got == {x: i for i, x in enumerate(sorted(values))}


@pytest.mark.parametrize("n", [0, 4, 8, 10, 11, 12, 90, 1000])
def test_rolling_throughput(spark, n):
    times = sorted(at((i * 13 % 97) * 10 + i // 50) for i in range(n))
    times[1:2] = [times[0]] if n > 1 else []
    times.sort()
    df = spark.createDataFrame([("s", t, i) for i, t in enumerate(times)], "s string, ts timestamp_ntz, i int")
    got = {r.i: r.throughput for r in ordered.rolling_throughput(df, ["s"], "ts", ("i",), cell_seconds=50).collect()}
    w = min(20, n // 4)
    want = {}
    for i in range(w, n) if n > 10 else ():
        seconds = (times[i] - times[i - w]).total_seconds()
        if seconds > 0:
            want[i] = w / seconds
    assert got == pytest.approx(want)


def test_histogram_edges(spark):
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in st.histogram(same, "v", 20).collect()] == [(0, 2)]
    df = spark.createDataFrame([(float(x),) for x in (0, 5, 10, 11)], "v double")
    assert {r.bin: r.n for r in st.histogram(df, "v", 2, 0, 10).collect()} == {0: 1, 1: 2}
    assert st.histogram(df.limit(0), "v", 5).count() == 0


def test_latest_and_newest(spark):
    rows = [("a", at(1), 1, None), ("a", at(2), 2, "x"), ("a", at(2), 3, None), ("b", None, 4, "y")]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i int, v string")
    assert {r.k: (r.i, r.v) for r in latest_per_key(df, ["k"], "ts", ("i",)).collect()} == {"a": (3, None), "b": (4, "y")}
    assert {(r.k, r.i) for r in newest_per_series(df, ["k"], 2, "ts", ("i",)).collect()} == {("a", 3), ("a", 2), ("b", 4)}


def test_error_frequency_and_metrics(spark):
    long_text = "e" * 100
    df = spark.createDataFrame([(long_text,), (long_text[:80] + "other",), (None,)], "error string")
    assert [(r.error, r.n) for r in st.error_frequency(df, "error").collect()] == [("e" * 80, 2), ("Unknown", 1)]
    scored = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("b", 2.0, 2.0), ("b", None, 1.0)], "s string, y double, p double")
    got = {r.s: (r.n, r.rmse, r.mae, r.r2) for r in st.regression_metrics(scored, ["s"], "y", "p").collect()}
    assert got == {"a": (2, 0.71, 0.5, 0.5), "b": (1, 0.0, 0.0, None)}


def test_trailing_cutoff_is_exclusive(spark):
    rows = [(at(0), "success", 10.0), (at(1), "success", 20.0), (at(30), "error", 99.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, status string, ms double")
    r = st.trailing_stats(df, ts="ts", succeeded=F.col("status") == "success", latency="ms", seconds=30, as_of=at(30)).first()
    assert (r.total, r.successful, r.failed, r.success_rate, r.avg_latency, r.p95_latency) == (2, 1, 1, 50.0, 20.0, 20.0)
    bad = df.withColumn("ms", F.when(F.col("ms") == 20, F.lit(float("nan"))).otherwise(F.col("ms")))
    assert st.trailing_stats(bad, ts="ts", succeeded=F.col("status") == "success", latency="ms", seconds=30, as_of=at(30)).first().avg_latency == 0.0
    none = st.trailing_stats(df, ts="ts", succeeded=F.col("status") == "success", latency="ms", seconds=30, as_of=at(10**6)).first()
    assert (none.total, none.avg_latency, none.p99_latency) == (0, 0.0, 0.0)


def test_order_statistics_survive_an_outlier(spark):
    df = spark.range(100_000).select((F.col("id") * 7 % 1000 + F.col("id") / 1e6).alias("v")).unionByName(spark.createDataFrame([(1e12,)], "v double"))
    cells = df.groupBy(ordered.value_cell(F.col("v")).alias("c")).count().agg(F.max("count")).first()[0]
    assert cells < 0.03 * 100_001
    r = ordered.nearest_rank_percentiles(df, [], "v", {"p50": 50, "p100": 100}).first()
    values = sorted(x.v for x in df.collect())
    assert (r.n, r.p50, r.p100) == (100_001, values[50_000], 1e12)


def test_value_cells_grow_with_the_value(spark):
    values = [float("-inf"), -1e300, -2.0, -1.0, -1e-300, -0.0, 0.0, 5e-324, 1e-9, 1.0, 1.0001, 3.0, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cells = [r.c for r in df.select(ordered.value_cell(F.col("v")).alias("c")).collect()]
    assert cells == sorted(cells) and cells[5] == cells[6] == 0


def test_order_statistics_keep_long_digits(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(big + i,) for i in range(5)], "v long")
    assert ordered.nearest_rank_percentiles(df, [], "v", {"p50": 50}).first().p50 == big + 2


def test_order_statistics_without_groups_have_no_product(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    plan = ordered.nearest_rank_percentiles(df, [], "v", {"p50": 50})._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
