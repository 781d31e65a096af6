"""Window tails and trailing windows against plain Python, and how they are dealt out."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.operators import windows
from riskloom.operators.statistics import sliding_window_stats
from riskloom.sources.scratch import new_folder
from riskloom.streaming import live

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, kind string, ts timestamp_ntz, ok boolean, value double"


def dense(seed, count, seconds):
    """Many rows a tick, with equal times, equal values and gaps in every column but the id."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        at = None if draw.random() < 0.02 else T0 + timedelta(microseconds=draw.choice([250_000, 1]) * draw.randrange(0, seconds * 4))
        value = draw.choice([None, float("nan"), 0.0, -3.5, 1e9]) if draw.random() < 0.1 else round(draw.lognormvariate(3, 2), draw.choice([0, 4]))
        rows.append((i, draw.choice(["a", "a", "a", "b", None]), at, draw.choice([True, True, False, None]), value))
    return rows


def real(v):
    return v is not None and v == v


def nearest(values, percent):
    values = sorted(values)
    return values[min(len(values) * percent // 100, len(values) - 1)] if values else None


def test_tails_of_sliding_windows(spark):
    rows = dense(1, 600, 40)
    got = windows.window_tails(spark.createDataFrame(rows, SCHEMA).filter("ok"), ts="ts", value="value", by=("kind",), window_seconds=10, slide_seconds=2,
                               percents={"p50": 50, "p95": 95, "p100": 100}).collect()
    want = {}
    for _, kind, at, ok, value in rows:
        if ok and at is not None and real(value):
            tick = at - timedelta(seconds=at.second % 2, microseconds=at.microsecond)
            for back in range(0, 10, 2):
                want.setdefault((kind, tick - timedelta(seconds=back)), []).append(value)
    assert {(r.kind, r.window_start): (r.p50, r.p95, r.p100) for r in got} == {k: tuple(nearest(v, p) for p in (50, 95, 100)) for k, v in want.items()}
    assert len(got) == len(want) > 20


def test_histograms_travel_by_span_and_not_by_window(spark):
    rows = spark.createDataFrame(dense(4, 300, 400), SCHEMA).filter("ok")
    values = windows.tick_values(rows, ts="ts", value="value", by=("kind",), slide_seconds=1)
    plan = windows.tail_targets(values, windows.TAILS, 30, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "explode(" not in plan  # a copy of each histogram for every window


def test_windows_of_a_span_are_the_same_however_few_copies_are_held():
    draw = random.Random(5)
    ticks, span = 5, 40
    rows = sorted({(draw.choice([1, 2, 3, 30, 31, 43, draw.randrange(span + ticks - 1)]), draw.randrange(-3, 4)) for _ in range(120)})
    many = [draw.randrange(1, 6) for _ in rows]
    table = pa.table({"_group": pa.array([{"_": 0}] * len(rows)), "_from": pa.array([T0] * len(rows)), "_at": pa.array([t for t, _ in rows], pa.int32()),
                      "_cell": pa.array([c for _, c in rows], pa.int32()), "_rows": pa.array(many, pa.int64())}).take(pa.array(draw.sample(range(len(rows)), len(rows))))
    want = set()
    for window in range(span):
        cells = sorted(c for (t, c), n in zip(rows, many) if window <= t < window + ticks for _ in range(n))
        for which, p in enumerate((50, 99.5)):
            if cells:
                position = min(int(len(cells) * p / 100), len(cells) - 1)
                want.add((window, which, cells[position], position - cells.index(cells[position])))
    for most in (1, 20, 10_000):
        got = windows._places(ticks, span, [50, 99.5], most)(table).to_pydict()
        assert len(got["which"]) == len(want) and set(zip(got["_window"], got["which"], got["_cell"], got["_offset"])) == want


def test_sliding_stats_without_successes_have_no_tails(spark):
    rows = [(1, "a", T0, False, 5.0), (2, "a", T0 + timedelta(seconds=100), True, 7.0), (3, "a", T0 + timedelta(seconds=100), True, None)]
    got = sliding_window_stats(spark.createDataFrame(rows, SCHEMA), ts="ts", succeeded=F.col("ok"), latency="value", by=("kind",))
    found = {(r.total, r.successful, r.p95_latency, r.p99_latency) for r in got.collect()}
    assert found == {(1, 0, None, None), (2, 2, 7.0, 7.0)} and got.count() == 60


def trailing(rows, seconds):
    out = {}
    for i, kind, at, _, _ in rows:
        if at is None:
            continue
        seen = [(o, v) for _, k, t, o, v in rows if k == kind and t is not None and at - timedelta(seconds=seconds) < t <= at]
        good = [v for o, v in seen if o]
        top = [v for v in good if v is not None]
        out[i] = (len(seen), len(good), max(top, key=lambda v: (v != v, v), default=None))
    return out


def test_trailing_windows_of_every_row(spark):
    rows = dense(2, 500, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    for seconds, tick in ((10, 2), (6, 6), (1, 1), (30, 1)):
        got = windows.trailing_per_event(df, series=["kind"], ts="ts", succeeded=F.col("ok"), latency="value", window_seconds=seconds, tick_seconds=tick).collect()
        assert {r.id: repr((r.window_total, r.window_successful, r.max_latency)) for r in got} == {k: repr(v) for k, v in trailing(rows, seconds).items()}
        one = {r.id: r.avg_latency for r in got}
        for i, kind, at, *_ in rows[:100]:
            good = [v for _, k, t, o, v in rows if at and k == kind and t and at - timedelta(seconds=seconds) < t <= at and o]
            if at and good:
                assert abs(one[i] - sum(v for v in good if real(v)) / len(good)) < 1e-5
    assert windows.trailing_per_event(df.limit(0), series=["kind"], ts="ts", succeeded=F.col("ok"), latency="value").count() == 0


def test_a_hot_series_is_spread_over_its_ticks(spark):
    df = spark.range(2000).selectExpr("CAST(id AS INT) AS id", "'hot' AS kind", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 10) AS ts", "true AS ok", "CAST(id AS DOUBLE) AS value")
    out = windows.trailing_per_event(df, series=["kind"], ts="ts", succeeded=F.col("ok"), latency="value", window_seconds=30, tick_seconds=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and all("_tick" in line for line in dealt) and "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert out.agg(F.max("window_total")).first()[0] == 300


def test_stream_tails_over_several_batches(spark):
    folder = new_folder(spark, "tails")
    rows = [r for r in dense(3, 900, 300) if r[2] is not None] + [(9999, "a", T0 + timedelta(hours=1), True, 1.0)]
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[2]), SCHEMA)
    for i, (low, high) in enumerate([(0, 100), (100, 200), (200, 4000)]):
        part = df.filter((F.col("ts") >= F.lit(str(T0 + timedelta(seconds=low))).cast("timestamp_ntz")) & (F.col("ts") < F.lit(str(T0 + timedelta(seconds=high))).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    how = {"ts": "ts", "succeeded": F.coalesce("ok", F.lit(False)), "latency": "value"}
    stats = live.window_stats(live.file_stream(spark, f"{folder}/in", df.schema, files_per_batch=1), **how)
    live.write_windows(stats, f"{folder}/out", f"{folder}/cp", df, **how).awaitTermination()
    got = {r.window_start: (r.total, r.p95_latency, r.p99_latency) for r in spark.read.parquet(f"{folder}/out").filter("window_start < timestamp_ntz'2024-01-01 00:30:00'").collect()}
    want = {}
    for _, _, at, ok, value in rows[:-1]:
        for back in range(30):
            both = want.setdefault(at.replace(microsecond=0) - timedelta(seconds=back), [0, []])
            both[0] += 1
            if ok and real(value):
                both[1].append(value)
    assert got == {k: (n, nearest(v, 95), nearest(v, 99)) for k, (n, v) in want.items()}


def test_a_stream_keeps_ticks_as_state_and_goes_on_after_a_restart(spark):
    folder = new_folder(spark, "restart")
    rows = [(i, "a", T0 + timedelta(seconds=7 * i, milliseconds=i), i % 3 > 0, float(i % 11)) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    how = {"ts": "ts", "succeeded": F.col("ok"), "latency": "value"}
    state = 0
    for low, high in ((0, 50), (50, 51), (51, 120)):
        df.filter((F.col("id") >= low) & (F.col("id") < high)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stats = live.window_stats(live.file_stream(spark, f"{folder}/in", df.schema), **how)
        query = live.write_windows(stats, f"{folder}/out", f"{folder}/cp", df, **how)
        query.awaitTermination()
        state = max([state] + [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress])
    assert state <= 3 * len(rows)  # not a row for each of a tick's thirty windows
    got = [tuple(r) for r in spark.read.parquet(f"{folder}/out").select("window_start", "total", "successful", "max_latency", "p95_latency", "p99_latency").collect()]
    want, finished = {}, rows[-1][2] - timedelta(minutes=1)
    for _, _, at, ok, value in rows:
        for back in range(30):
            start = at.replace(microsecond=0) - timedelta(seconds=back)
            if start + timedelta(seconds=30) <= finished:
                want.setdefault(start, []).append(value if ok else None)
    good = {k: [x for x in v if x is not None] for k, v in want.items()}
    assert sorted(got) == sorted((k, len(v), len(good[k]), max(good[k], default=None), nearest(good[k], 95), nearest(good[k], 99)) for k, v in want.items())
