"""Point-in-time joins, latest rows, order statistics, windows: queries and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import Query
from riskloom.catalog import sql as q
from riskloom.functions import rating
from riskloom.functions.numeric import rounded
from riskloom.operators import latest, ordered, statistics as st, windows
from riskloom.operators.asof import asof_join
from riskloom.plans import features as pf
from riskloom.sources import views as v

YEAR = v.YEAR
MONTH_CELL = 30 * 86400


def asof_features(spark, d):
    events = v.table(spark, d, "events")
    clicks = events.filter(F.col("event_type") == "click").select(
        "user_id", F.col("ts").alias("feature_ts"), F.col("event_id").alias("feature_id"), F.col("value").alias("feature_value"))
    purchases = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    return asof_join(purchases, clicks, on=["user_id"], left_ts="ts", right_ts="feature_ts", tiebreak=("feature_id",))


def asof_training_set(spark, d):
    """Policies with their owner's totals as of the start of the month, from monthly snapshots."""
    policies = v.policies(spark, d)
    month = F.date_trunc("MONTH", "updated_at").cast("timestamp_ntz")
    known = month + F.expr("INTERVAL '1' MONTH")
    snapshots = policies.groupBy("customer_id", known.alias("updated_at")).agg(
        F.count("policy_id").alias("month_policies"), F.max("kilometers").alias("most_kilometers"),
        rounded(F.avg(rating.car_age("car_year", YEAR)), 2).alias("month_car_age"))
    spine = pf.training_spine(policies, v.customers(spark, d), year=YEAR, keep=("policy_id",)).select(
        "policy_id", "customer_id", "car_age", "annual_premium", "ts")
    return pf.enriched_spine(spine, snapshots, cell_seconds=MONTH_CELL)


def latest_per_key(spark, d):
    return latest.latest_per_key(v.table(spark, d, "events").drop("props"), ["user_id"], "ts", ("event_id",))


def retrieve_latest(spark, d):
    spine = v.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return latest.retrieve_latest(
        spine, v.table(spark, d, "events").drop("props"), on="user_id", feature_ts="ts", tiebreak=("event_id",))


def nearest_rank_percentiles(spark, d):
    return ordered.nearest_rank_percentiles(
        v.table(spark, d, "events"), ["event_type"], "value", {"p50": 50, "p95": 95, "p99": 99, "p100": 100})


def latency_stats(spark, d):
    return st.latency_stats(v.table(spark, d, "events"), ["event_type"], "value", "user_id")


def trailing_window_stats(spark, d):
    return st.trailing_stats(
        v.table(spark, d, "events"), ts="ts", succeeded=F.col("event_type") != "error", latency="value",
        seconds=7 * 86400, as_of=q.AS_OF, components=("user_id",))


def sliding_window_stats(spark, d):
    return st.sliding_window_stats(v.table(spark, d, "events"), ts="ts", succeeded=F.col("event_type") != "error", latency="value")


def trailing_per_event(spark, d):
    """Each event with the last hour of its kind."""
    return windows.trailing_per_event(
        v.table(spark, d, "events").select("event_id", "event_type", "ts", "user_id", "value"), series=["event_type"], ts="ts",
        succeeded=F.col("user_id") % 7 != 0, latency="value", window_seconds=3600, tick_seconds=60)


def rolling_throughput(spark, d):
    rolled = ordered.rolling_throughput(
        v.table(spark, d, "events").select("event_id", "event_type", "ts"), ["event_type"], "ts", ("event_id",))
    return rolled.select("event_id", "event_type", "window_rows", rounded("throughput", 6).alias("throughput"))


def last_n_per_series(spark, d):
    return latest.newest_per_series(v.table(spark, d, "events").drop("props"), ["event_type"], 10, "ts", ("event_id",))


def ordered_positions(spark, d):
    events = v.table(spark, d, "events").select("event_id", "event_type", "ts")
    return ordered.with_position(events, ["event_type"], ["ts", "event_id"], ordered.time_cell("ts", 3600))


def request_quantiles(spark, d):
    found = ordered.interpolated_quantiles(
        v.table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", {"q10": 0.1, "q50": 0.5, "q90": 0.9})
    return found.select("o_orderpriority", "n", *[rounded(c, 4).alias(c) for c in ("q10", "q50", "q90")])


def nearest(prefix: str, suffix: str, percents=(50, 95, 99)) -> str:
    return ", ".join(
        f"max(CASE WHEN rn = least((n * {p}) // 100 + 1, n) THEN value END) AS {prefix}p{p}{suffix}" for p in percents)


RANKED = """SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events"""

QUERIES: dict[str, Query] = {
    "asof_features": Query(asof_features, """
SELECT p.event_id, p.user_id, p.ts, p.value, c.feature_ts, c.feature_id, c.feature_value
FROM (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts AS feature_ts, event_id AS feature_id, value AS feature_value FROM events WHERE event_type = 'click') c
ON p.user_id = c.user_id AND p.ts >= c.feature_ts"""),
    "asof_training_set": Query(asof_training_set, q.with_(f"""
SELECT p.policy_id, p.customer_id, {YEAR} - p.car_year AS car_age, p.annual_premium, p.updated_at AS ts,
  s.feature_ts, s.month_policies, s.most_kilometers, s.month_car_age
FROM policies p ASOF LEFT JOIN snapshots s ON p.customer_id = s.customer_id AND p.updated_at >= s.feature_ts""",
        **q.PRICED, snapshots=f"""
SELECT customer_id, (date_trunc('month', updated_at) + INTERVAL 1 MONTH)::TIMESTAMP AS feature_ts, count(*) AS month_policies,
  max(kilometers) AS most_kilometers, {q.rounded(f'avg({YEAR} - car_year)', 2)} AS month_car_age FROM policies GROUP BY 1, 2""")),
    "latest_per_key": Query(latest_per_key, """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "retrieve_latest": Query(retrieve_latest, """
SELECT c_custkey AS user_id, c_mktsegment, event_id, ts, event_type, value FROM customer LEFT JOIN (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e ON c_custkey = user_id"""),
    "nearest_rank_percentiles": Query(nearest_rank_percentiles, f"""
SELECT event_type, any_value(n) AS n, {nearest('', '', (50, 95, 99, 100))} FROM ({RANKED}) GROUP BY 1"""),
    "latency_stats": Query(latency_stats, f"""
SELECT event_type, any_value(n) AS total_inferences, sum(value::DECIMAL(28,6))::DOUBLE / any_value(n) AS avg_latency_ms,
  min(value) AS min_latency_ms, max(value) AS max_latency_ms, {nearest('', '_latency_ms')}, count(DISTINCT user_id) AS unique_queries
FROM ({RANKED}) GROUP BY 1"""),
    "trailing_window_stats": Query(trailing_window_stats, f"""
WITH recent AS (SELECT *, event_type <> 'error' AS ok FROM events WHERE ts > TIMESTAMP '{q.AS_OF}' - INTERVAL 604800 SECOND),
good AS (SELECT *, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM recent WHERE ok)
SELECT count(*) AS total, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed,
  (count(*) FILTER (ok) * 100) / count(*) AS success_rate, count(*) / 604800e0 AS throughput,
  sum(value::DECIMAL(28,6)) FILTER (ok)::DOUBLE / count(*) FILTER (ok) AS avg_latency,
  sum(user_id::DECIMAL(28,6)) FILTER (ok AND user_id <> 0)::DOUBLE / count(*) FILTER (ok AND user_id <> 0) AS avg_user_id,
  (SELECT max(CASE WHEN rn = least((n * 95) // 100 + 1, n) THEN value END) FROM good) AS p95_latency,
  (SELECT max(CASE WHEN rn = least((n * 99) // 100 + 1, n) THEN value END) FROM good) AS p99_latency
FROM recent"""),
    "sliding_window_stats": Query(sliding_window_stats, f"""
WITH spread AS (SELECT *, event_type <> 'error' AS ok, date_trunc('second', ts) - to_seconds(s) AS window_start FROM events, range(30) r(s)),
tails AS (SELECT window_start, {', '.join(f"max(CASE WHEN rn = least((n * {p}) // 100 + 1, n) THEN value END) AS p{p}_latency" for p in (95, 99))}
  FROM (SELECT window_start, value, row_number() OVER (PARTITION BY window_start ORDER BY value) AS rn, count(*) OVER (PARTITION BY window_start) AS n
    FROM spread WHERE ok AND value IS NOT NULL) GROUP BY 1)
SELECT window_start, count(*) AS total, count(*) FILTER (ok) AS successful,
  (count(*) FILTER (ok) * 100) / count(*) AS success_rate,
  sum(value::DECIMAL(28,6)) FILTER (ok)::DOUBLE / count(*) FILTER (ok) AS avg_latency, max(value) FILTER (ok) AS max_latency,
  window_start + INTERVAL 30 SECOND AS window_end, any_value(p95_latency) AS p95_latency, any_value(p99_latency) AS p99_latency
FROM spread LEFT JOIN tails USING (window_start) GROUP BY window_start"""),
    "trailing_per_event": Query(trailing_per_event, """
SELECT event_id, event_type, ts, user_id, value, count(*) OVER w AS window_total, count(*) FILTER (ok) OVER w AS window_successful,
  (count(*) FILTER (ok) OVER w * 100) / count(*) OVER w AS success_rate, count(*) OVER w / 3600e0 AS throughput,
  (sum(value::DECIMAL(28,6)) FILTER (ok) OVER w)::DOUBLE / nullif(count(*) FILTER (ok) OVER w, 0) AS avg_latency, max(value) FILTER (ok) OVER w AS max_latency
FROM (SELECT *, user_id % 7 <> 0 AS ok FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3599999999 MICROSECOND PRECEDING AND CURRENT ROW)"""),
    "rolling_throughput": Query(rolling_throughput, f"""
WITH p AS (SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i,
  count(*) OVER (PARTITION BY event_type) AS n FROM events),
w AS (SELECT *, least(20, n // 4) AS w FROM p WHERE n > 10)
SELECT a.event_id, a.event_type, a.w AS window_rows,
  {q.rounded("a.w / ((epoch_us(a.ts) - epoch_us(b.ts)) / 1000000e0)", 6)} AS throughput
FROM w a JOIN w b ON a.event_type = b.event_type AND a.i - a.w = b.i WHERE a.w > 0 AND a.ts > b.ts"""),
    "last_n_per_series": Query(last_n_per_series, """
SELECT event_id, ts, user_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC)::INTEGER AS row_rank
FROM events QUALIFY row_rank <= 10"""),
    "ordered_positions": Query(ordered_positions, """
SELECT event_id, event_type, ts, count(*) OVER (PARTITION BY event_type) AS group_rows,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS position FROM events"""),
    "request_quantiles": Query(request_quantiles, f"""
SELECT o_orderpriority, count(*) AS n, {q.rounded('quantile_cont(o_totalprice, 0.1)', 4)} AS q10,
  {q.rounded('quantile_cont(o_totalprice, 0.5)', 4)} AS q50, {q.rounded('quantile_cont(o_totalprice, 0.9)', 4)} AS q90
FROM orders GROUP BY 1"""),
}
