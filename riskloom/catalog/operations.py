"""Serving log, telemetry, incremental processing, registry: queries and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.catalog import Query
from riskloom.catalog import preparation
from riskloom.catalog import relational as rel
from riskloom.catalog import sql as q
from riskloom.functions.numeric import rounded
from riskloom.functions.times import clock
from riskloom.operators import daily
from riskloom.operators.ordered import nearest_rank_percentiles
from riskloom.operators.statistics import histogram
from riskloom.plans import registry, telemetry
from riskloom.sources import serving_log, views as v
from riskloom.sources.scratch import new_folder, written
from riskloom.streaming import increment, live, progress

MARK = "2024-01-10 00:00:00"
LOG_SECONDS = 20 * 86400


def events(spark, d):
    return v.table(spark, d, "events")


def event_log(spark, d):
    """Events as log records: the kind is the function, ``k`` an input, ``value`` prediction and latency."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    scored = events(spark, d).select(
        "event_id", "ts", "event_type", "value", k.alias("age"), F.col("value").alias("estimated_car_value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("car_make"), F.col("value").alias(fv.PREDICTION_COL))
    answered = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 1000).cast("bigint"), F.col("ts"))
    records = serving_log.capture(
        scored, query_id=F.col("event_id").cast("string"), at=F.col("ts"), request_time=F.col("ts"),
        response_time=F.when(F.col("event_type") != "view", answered))
    return records


def log_extract(spark, d):
    return serving_log.extract(event_log(spark, d)).select(
        "timestamp", "query_id", "service_name", "function_name", "request_timestamp", "response_timestamp",
        "age", "estimated_car_value", "car_make", "credit_score", fv.PREDICTION_COL)


def log_round_trip(spark, d):
    inputs = rel.inference_input(spark, d).withColumn(fv.PREDICTION_COL, F.col("estimated_car_value"))
    log = serving_log.capture(inputs, query_id=F.col("policy_id"), at=q.AS_OF)
    return serving_log.extract(log).select(F.col("query_id").alias("policy_id"), *fv.MODEL_INPUT_COLS)


def log_object(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return events(spark, d).select("event_id", serving_log.object_of(KIND=kind, K=k).alias("object"))


def log_listing(spark, d):
    return telemetry.log_listing(event_log(spark, d))


def log_latency(spark, d):
    return telemetry.log_latencies(event_log(spark, d), seconds=LOG_SECONDS, as_of=q.AS_OF)


def latency_panel(spark, d):
    return telemetry.latency_panel(log_latency(spark, d))


def latency_preview(spark, d):
    return telemetry.latency_preview(log_latency(spark, d))


def latency_log_histogram(spark, d):
    """Latencies of zero stand for requests that were not timed; they stay out."""
    bins = histogram(log_latency(spark, d).filter("inference_latency_ms != 0"), "inference_latency_ms", 30)
    return bins.withColumns({c: rounded(c, 6) for c in ("bin_start", "bin_end")})


def results(spark, d):
    """Events as load-test results."""
    failed = F.col("event_type") == "error"
    return events(spark, d).select(
        F.col("event_id").alias("request_id"), F.col("ts").alias("timestamp"),
        F.when(failed, "error").otherwise("success").alias("status"), F.col("value").alias("latency_ms"),
        (F.col("value") * 10).alias(fv.PREDICTION_COL),
        F.col("event_type").alias("car_make"), F.get_json_object("props", "$.k").alias("car_model"),
        F.when(F.col("event_type") == "signup", "new").otherwise("existing").alias("customer_type"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias("customer_id"),
        (F.col("value") / 4).alias("feature_store_ms"), (F.col("value") / 2).alias("model_inference_ms"),
        F.when(failed, F.concat(F.lit("upstream failed: "), F.col("props"))).alias("error"))


def request_analytics(spark, d):
    return telemetry.request_totals(results(spark, d), ["customer_type"], 86400.0 * 30)


def customer_type_counts(spark, d):
    return telemetry.customer_type_counts(results(spark, d))


def failure_causes(spark, d):
    return telemetry.failures(results(spark, d))


def recent_display(spark, d):
    return telemetry.recent_predictions(results(spark, d))


def component_percentiles(spark, d):
    return nearest_rank_percentiles(
        results(spark, d).filter(F.col("status") == "success"), ["customer_type"], "feature_store_ms", {"p50": 50, "p99": 99})


def runs(spark, d):
    failed = F.col("event_type") == "error"
    return events(spark, d).select(
        F.col("event_type").alias("name"), F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"), F.timestamp_add("SECOND", F.lit(60), F.col("ts")).alias("completed_time"),
        F.when(failed, F.col("props")).alias("error_message"))


def run_history(spark, d):
    return telemetry.run_history(runs(spark, d), seconds=86400, as_of="2024-01-30 00:00:00")


def alert_list(spark, d):
    return telemetry.alerts_newest_first(events(spark, d).filter(F.col("event_type") == "error").select(
        F.col("ts").alias("alert_time"), F.lit("MODEL_QUALITY").alias("alert_type"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message")))


# --- registry -----------------------------------------------------------------------------------

def model_events(spark, d):
    """Events as registry events: three consecutive events tell the story of one version."""
    number = F.floor(F.col("event_id") / 3).cast("bigint")
    kind = (
        F.when(F.col("event_type") == "purchase", "promote").when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "click", "metric").otherwise("register"))
    measured = F.col("event_type").isin("click", "signup", "view")
    # Every fourth measurement is of another metric only; the gate's metric must outlive it.
    name = F.when(F.col("event_id") % 4 == 0, F.lit("rmse")).otherwise(fv.GATE_METRIC)
    return events(spark, d).select(
        F.concat(F.lit("m"), (number % 5).cast("string")).alias("model"),
        F.concat(F.lit("v"), number.cast("string")).alias("version"), kind.alias("event"),
        F.when(measured, F.create_map(name, F.col("value") / 500)).alias("metrics"),
        F.lit(None).cast("string").alias("artifact_path"), F.lit(None).cast("string").alias("comment"),
        F.col("ts").alias("event_ts"))


def registry_state(spark, d):
    return registry.version_state(model_events(spark, d)).select(
        "model", "version", "created_on", F.col("metrics")[fv.GATE_METRIC].alias("test_r2"), "is_default")


def current_default(spark, d):
    return registry.current_default(model_events(spark, d))


def quality_gate(spark, d):
    """Every ninth candidate's score is not a number."""
    score = F.when(F.col("p_partkey") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("p_size") / 50)
    candidates = v.table(spark, d, "part").select(
        F.concat(F.lit("m"), (F.col("p_partkey") % 7).cast("string")).alias("model"),
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("version"), score.alias("score"))
    return registry.gate_decisions(candidates, model_events(spark, d)).select("model", "version", "decision")


def expire_versions(spark, d):
    return registry.expired_versions(model_events(spark, d), as_of=q.AS_OF).drop("artifact_path")


MODEL_EVENTS_SQL = """
SELECT 'm' || (event_id // 3) % 5 AS model, 'v' || (event_id // 3) AS version, ts AS event_ts, event_type AS kind,
  CASE event_type WHEN 'purchase' THEN 'promote' WHEN 'error' THEN 'delete' WHEN 'click' THEN 'metric' ELSE 'register' END AS event,
  CASE WHEN event_type IN ('click', 'signup', 'view') AND event_id % 4 <> 0 THEN value / 500 END AS metric FROM events"""
STATE_SQL = """
SELECT s.model, s.version, created_on, test_r2, coalesce(d.version = s.version, false) AS is_default
FROM (SELECT model, version, min(event_ts) FILTER (event = 'register') AS created_on,
    arg_max(metric, event_ts) FILTER (metric IS NOT NULL) AS test_r2, bool_or(event = 'delete') AS gone
  FROM mev GROUP BY 1, 2) s LEFT JOIN dflt d ON d.model = s.model WHERE created_on IS NOT NULL AND NOT gone"""
DEFAULT_SQL = "SELECT model, arg_max(version, event_ts) AS version, max(event_ts) AS promoted_at FROM mev WHERE event = 'promote' GROUP BY 1"
STATE = {"mev": MODEL_EVENTS_SQL, "dflt": DEFAULT_SQL, "state": STATE_SQL}


# --- incremental --------------------------------------------------------------------------------

def upper_log(spark, d):
    return events(spark, d).select(
        F.col("ts").alias("timestamp"), F.upper("event_type").alias("function_name"), "event_id", "user_id", "value")


def purchases_of(log):
    return increment.is_function(log, "purchase")


def incremental_new_max(spark, d):
    log = upper_log(spark, d)
    return increment.new_mark(log, MARK, purchases_of(log))


def incremental_interval(spark, d):
    log = upper_log(spark, d)
    high = increment.new_mark(log, MARK, purchases_of(log)).scalar()
    return increment.interval(log, MARK, high, purchases_of(log))


def scored_log(spark, d, folder):
    """Model inputs written as a serving log, the hour after ``AS_OF`` being the car's age; with the
    function that turns log records into rounded result rows."""
    inputs = preparation.frozen_inputs(spark, d)
    encoder, scaler = preparation.fitted_preparation(inputs)
    at = F.timestamp_add("HOUR", F.col("car_age"), clock(q.AS_OF))
    log = serving_log.capture(
        inputs.withColumn(fv.PREDICTION_COL, F.col("estimated_car_value")), query_id=F.col("policy_id"), at=at, function_name="Predict")
    # Calls of other functions are in the log as well; they are not to be processed.
    other = log.withColumn("function_name", F.lit("transform"))
    serving_log.append_log(log.unionByName(other), f"{folder}/log")

    def rows(part):
        done = increment.transformation_rows(part, encoder, scaler, at=q.AS_OF)
        return done.withColumns({c: rounded(c, 6) for c in [*[f"{n}_transformed" for n in fv.NUMERIC_COLS], *fv.ENCODED_COLS]})

    return rows


def increment_run(spark, d):
    """The incremental job: log records in, 50 result columns out, the mark moved. The first run sees
    only part of the log, the second the rest, the third nothing new."""
    folder = new_folder(spark, "increment")
    rows = scored_log(spark, d, folder)
    log = serving_log.read_log(spark, f"{folder}/log")
    marks = increment.Watermarks(spark, f"{folder}/marks")
    early = F.timestamp_add("HOUR", F.lit(10), clock(q.AS_OF))
    for part in (log.filter(F.col("timestamp") <= early), log, log):
        increment.process_increment(part, marks, f"{folder}/results", rows)
    return spark.read.parquet(f"{folder}/results").drop("mark", "after").withColumn(
        "last_processed", marks.read().select("last_processed").scalar())


def stream_path(d: str) -> str:
    """A glob for the events table: matches it as one file and as a folder of files."""
    return f"{d}/event[s].parquet"


def stream_increment(spark, d):
    """The same job as a stream over the log's files."""
    folder = new_folder(spark, "stream")
    rows = scored_log(spark, d, folder)
    increment.start_stream(spark, f"{folder}/log", f"{folder}/results", f"{folder}/checkpoint", rows, files_per_batch=8).awaitTermination()
    return spark.read.parquet(f"{folder}/results").drop("batch_id")


def stream_progress(spark, d):
    """What the progress table says of a stream over the events: batches and rows."""
    folder = new_folder(spark, "progress")
    listener = progress.ProgressRows(spark, f"{folder}/progress")
    spark.streams.addListener(listener)
    try:
        clicks = lambda log: F.col("event_type") == "click"
        query = increment.start_stream(spark, stream_path(d), f"{folder}/out", f"{folder}/checkpoint", lambda b: b.select("event_id"),
                                       schema=events(spark, d).schema, condition=clicks)
        query.awaitTermination()
        listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    kept = spark.read.parquet(f"{folder}/out").agg(F.count("*")).scalar()
    mine = progress.history(spark, f"{folder}/progress").filter(F.col("query_id") == str(query.id))
    return mine.select("batches", "input_rows", kept.alias("kept_rows"), F.col("slowest_ms").isNotNull().alias("is_timed"))


def stream_window(spark, d):
    folder = new_folder(spark, "windows")
    stream = live.file_stream(spark, stream_path(d), events(spark, d).schema)
    how = {"ts": "ts", "succeeded": F.col("event_type") != "error", "latency": "value"}
    live.write_windows(live.window_stats(stream, **how), f"{folder}/out", f"{folder}/checkpoint", events(spark, d), **how).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


def stream_latest(spark, d):
    folder = new_folder(spark, "latest")
    stream = live.file_stream(spark, stream_path(d), events(spark, d).schema).drop("props")
    how = {"keys": ["user_id"], "ts": "ts", "tiebreak": ("event_id",)}
    live.keep_latest(stream, f"{folder}/table", f"{folder}/checkpoint", **how).awaitTermination()
    live.compact_latest(spark, f"{folder}/table", **how)
    return live.latest_table(spark, f"{folder}/table", **how)


LATENCY_SQL = f"""
SELECT ts AS timestamp, event_id::VARCHAR AS query_id, 'pricing' AS service_name, ts AS request_timestamp,
  CASE WHEN event_type <> 'view' THEN ts + to_microseconds(round(value * 1000)::BIGINT) END AS response_timestamp,
  CASE WHEN event_type <> 'view' THEN date_diff('millisecond', ts, ts + to_microseconds(round(value * 1000)::BIGINT)) END AS inference_latency_ms
FROM events WHERE ts >= TIMESTAMP '{q.AS_OF}' - INTERVAL {LOG_SECONDS} SECOND"""

RESULTS_SQL = """
SELECT event_id AS request_id, ts AS timestamp, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
  value AS latency_ms, value * 10 AS predicted_premium, event_type || ' ' || json_extract_string(props, '$.k') AS car, CASE WHEN event_type = 'signup' THEN 'new' ELSE 'existing' END AS customer_type,
  CASE WHEN event_type <> 'signup' THEN 'C' || user_id END AS customer_id, value / 4 AS feature_store_ms, value / 2 AS model_inference_ms,
  CASE WHEN event_type = 'error' THEN 'upstream failed: ' || props END AS error FROM events"""

SERVED_SQL = f"TIMESTAMP '{q.AS_OF}' + to_hours(car_age::INTEGER)"
WHOLE_NUMBERS = ("avg_kilometers", "avg_deductible")
RESULT_COLUMNS_SQL = ", ".join([
    f"{SERVED_SQL} AS inference_timestamp", "policy_id AS query_id", "'pricing' AS service_name", "'Predict' AS function_name",
    f"TIMESTAMP '{q.AS_OF}' AS transform_timestamp",
    *[f"{c}{'::BIGINT' if c in WHOLE_NUMBERS else ''} AS {c}_input" for c in fv.MODEL_INPUT_COLS],
    f"estimated_car_value AS {fv.PREDICTION_COL}",
    *[f"{preparation.z(c)} AS {c}_transformed" for c in fv.NUMERIC_COLS], *[f"{preparation.z(c)} AS {c}" for c in fv.ENCODED_COLS]])
WHOLE = "round(({})::DECIMAL(28,8), 0)::BIGINT::VARCHAR"

STATE_DAYS = ("2024-01-05", "2024-01-24")


def daily_state_range(spark, d):
    """States of two batches that meet inside a day, merged over twenty days, next to a count of the distinct users."""
    rows, by = events(spark, d), ("event_type",)
    batches = [rows.where(f"ts <= TIMESTAMP '{MARK}' + INTERVAL 7 HOUR"), rows.where(f"ts > TIMESTAMP '{MARK}' + INTERVAL 7 HOUR")]
    first, second = (written(daily.daily_states(b, ts="ts", value="value", distinct="user_id", by=by), "daily-states") for b in batches)
    merged = daily.merged_states(first.unionByName(second), {f"p{p}": p for p in (50, 95, 99)}, by=by, since=STATE_DAYS[0], until=STATE_DAYS[1])
    users = rows.where(F.to_date("ts").between(*[F.lit(x).cast("date") for x in STATE_DAYS])).groupBy(*by).agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * daily.DISTINCT_ERROR)
    return merged.join(users, "event_type").select("event_type", "n_rows", "n", F.col("mean"), "lo", "hi", "users", near.alias("distinct_is_near"), "p50", "p95", "p99")


# The exact value at each position, found by sorting, moved to the middle of its cell: what merged histograms must give.
DAILY_STATE_SQL = f"""
WITH e AS (SELECT event_type, user_id, value::DOUBLE AS v FROM events WHERE ts::DATE BETWEEN DATE '{STATE_DAYS[0]}' AND DATE '{STATE_DAYS[1]}'),
s AS (SELECT event_type, count(*) AS n_rows, count(v) AS n, sum(v::DECIMAL(28,6))::DOUBLE / nullif(count(v), 0) AS mean, min(v) AS lo, max(v) AS hi,
  count(DISTINCT user_id) AS users FROM e GROUP BY 1),
r AS (SELECT event_type, v, row_number() OVER w AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM e WHERE v IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY v)),
t AS (SELECT event_type, {', '.join(f"max(CASE WHEN rn = least((n * {p}) // 100 + 1, n) THEN v END) AS x{p}" for p in (50, 95, 99))} FROM r GROUP BY 1),
d AS (SELECT event_type, {', '.join(f"x{p}, pow(2e0, floor(log2(abs(x{p})))) AS d{p}" for p in (50, 95, 99))} FROM t)
SELECT event_type, n_rows, n, mean, lo, hi, users, true AS distinct_is_near,
  {', '.join(f"CASE WHEN x{p} IS NULL THEN NULL ELSE least(greatest(CASE WHEN abs(x{p}) < pow(2e0, -{daily.LOWEST}) THEN 0e0 ELSE sign(x{p}) * d{p} * (1 + (floor((abs(x{p}) / d{p} - 1) * {daily.CELLS}) + 0.5e0) / {daily.CELLS}) END, lo), hi) END AS p{p}" for p in (50, 95, 99))}
FROM s LEFT JOIN d USING (event_type)"""

QUERIES: dict[str, Query] = {
    "log_extract": Query(log_extract, """
SELECT ts AS timestamp, event_id::VARCHAR AS query_id, 'pricing' AS service_name, 'predict' AS function_name, ts AS request_timestamp,
  CASE WHEN event_type <> 'view' THEN ts + to_microseconds(round(value * 1000)::BIGINT) END AS response_timestamp,
  json_extract_string(props, '$.k')::BIGINT AS age, value AS estimated_car_value,
  CASE WHEN event_type <> 'error' THEN event_type END AS car_make, NULL::BIGINT AS credit_score, value AS predicted_premium FROM events"""),
    "log_round_trip": Query(log_round_trip, q.with_(
        "SELECT * REPLACE (avg_kilometers::BIGINT AS avg_kilometers, avg_deductible::BIGINT AS avg_deductible) FROM input",
        **q.FEATURED, input=q.MODEL_INPUT)),
    "log_object": Query(log_object, """
SELECT event_id, '{' || CASE WHEN event_type <> 'error' THEN '"KIND":"' || event_type || '",' ELSE '' END
  || '"K":' || json_extract_string(props, '$.k') || '}' AS object FROM events"""),
    "log_listing": Query(log_listing, """
SELECT ts AS timestamp, event_id::VARCHAR AS query_id, 'pricing' AS service_name, 'predict' AS function_name,
  '{"ESTIMATED_CAR_VALUE":' || value || ',"AGE":' || json_extract_string(props, '$.k')
  || CASE WHEN event_type <> 'error' THEN ',"CAR_MAKE":"' || event_type || '"' ELSE '' END || '}' AS input_data, value AS predicted_premium
FROM events ORDER BY ts DESC LIMIT 20"""),
    "log_latency": Query(log_latency, LATENCY_SQL),
    "latency_panel": Query(latency_panel, f"""
WITH l AS ({LATENCY_SQL}), r AS (SELECT inference_latency_ms AS v, row_number() OVER (ORDER BY inference_latency_ms) AS rn, count(*) OVER () AS n
  FROM l WHERE inference_latency_ms IS NOT NULL)
SELECT count(*) AS total_inferences, avg(inference_latency_ms) AS avg_latency_ms, min(inference_latency_ms) AS min_latency_ms,
  max(inference_latency_ms) AS max_latency_ms, {', '.join(f'(SELECT max(v) FROM r WHERE rn = least((n * {p}) // 100 + 1, n))::DOUBLE AS p{p}_latency_ms' for p in (50, 95, 99))},
  count(DISTINCT query_id) AS unique_queries, 'pricing' AS service_name FROM l"""),
    "latency_preview": Query(latency_preview, f"SELECT timestamp, query_id, inference_latency_ms FROM ({LATENCY_SQL}) ORDER BY timestamp DESC LIMIT 100"),
    "latency_log_histogram": Query(latency_log_histogram, f"""
WITH l AS (SELECT inference_latency_ms::DOUBLE AS v FROM ({LATENCY_SQL}) WHERE inference_latency_ms <> 0),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM l),
b AS (SELECT least(floor((v - lo) / (hi - lo) * 30), 29)::INTEGER AS bin, count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi FROM l, e GROUP BY 1)
SELECT bin, {q.rounded('lo + bin * ((hi - lo) / 30)', 6)} AS bin_start, {q.rounded('lo + (bin + 1) * ((hi - lo) / 30)', 6)} AS bin_end, n FROM b"""),
    "request_analytics": Query(request_analytics, q.with_("""
SELECT customer_type, count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status <> 'success') AS failed,
  (count(*) FILTER (status = 'success') * 100) / count(*) AS success_rate, count(*) / 2592000e0 AS throughput FROM r GROUP BY 1""", r=RESULTS_SQL)),
    "customer_type_counts": Query(customer_type_counts, q.with_(
        "SELECT customer_type, count(*) AS n FROM r WHERE status = 'success' GROUP BY 1", r=RESULTS_SQL)),
    "failure_causes": Query(failure_causes, q.with_(
        "SELECT substring(error, 1, 80) AS error, count(*) AS n FROM r WHERE status = 'error' GROUP BY 1", r=RESULTS_SQL)),
    "recent_display": Query(recent_display, q.with_(f"""
SELECT request_id, strftime(timestamp, '%H:%M:%S') AS "time", coalesce(customer_id, 'New') AS customer, customer_type AS type, car,
  '$' || format('{{:,.2f}}', {q.rounded('predicted_premium', 2)}) AS premium, {WHOLE.format('latency_ms')} AS total_ms,
  {WHOLE.format('feature_store_ms')} AS feature_ms, {WHOLE.format('model_inference_ms')} AS model_ms
FROM r WHERE status = 'success' ORDER BY timestamp DESC LIMIT 10""", r=RESULTS_SQL)),
    "component_percentiles": Query(component_percentiles, q.with_("""
SELECT customer_type, any_value(n) AS n, max(CASE WHEN rn = least((n * 50) // 100 + 1, n) THEN v END) AS p50,
  max(CASE WHEN rn = least((n * 99) // 100 + 1, n) THEN v END) AS p99
FROM (SELECT customer_type, feature_store_ms AS v, row_number() OVER (PARTITION BY customer_type ORDER BY feature_store_ms) AS rn,
  count(*) OVER (PARTITION BY customer_type) AS n FROM r WHERE status = 'success') GROUP BY 1""", r=RESULTS_SQL)),
    "run_history": Query(run_history, """
SELECT event_type AS name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, ts AS scheduled_time,
  ts + INTERVAL 60 SECOND AS completed_time, CASE WHEN event_type = 'error' THEN props END AS error_message
FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' ORDER BY ts DESC LIMIT 10"""),
    "alert_list": Query(alert_list, """
SELECT ts AS alert_time, 'MODEL_QUALITY' AS alert_type, 'event ' || event_id AS message FROM events WHERE event_type = 'error' ORDER BY ts DESC"""),
    "registry_state": Query(registry_state, q.with_("SELECT * FROM state", **STATE)),
    "current_default": Query(current_default, q.with_("SELECT * FROM dflt", **STATE)),
    "quality_gate": Query(quality_gate, q.with_("""
SELECT c.model, c.version, CASE WHEN p.version IS NULL OR (c.score >= 0.7e0 AND c.score >= coalesce(p.test_r2, 0))
  THEN 'promote_model' ELSE 'send_alert' END AS decision
FROM (SELECT 'm' || p_partkey % 7 AS model, 'c' || p_partkey AS version, CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_size / 50 END AS score FROM part) c
LEFT JOIN (SELECT * FROM state WHERE is_default) p ON p.model = c.model""", **STATE)),
    "expire_versions": Query(expire_versions, q.with_(f"""
SELECT model, version, created_on FROM state WHERE NOT is_default AND created_on < TIMESTAMP '{q.AS_OF}' - INTERVAL 7 DAY
  AND model IN (SELECT model FROM dflt)""", **STATE)),
    "incremental_new_max": Query(incremental_new_max, f"SELECT max(ts) AS new_mark FROM events WHERE ts > TIMESTAMP '{MARK}' AND event_type = 'purchase'"),
    "incremental_interval": Query(incremental_interval, f"""
SELECT ts AS timestamp, upper(event_type) AS function_name, event_id, user_id, value FROM events
WHERE ts > TIMESTAMP '{MARK}' AND ts <= (SELECT max(ts) FROM events WHERE event_type = 'purchase') AND event_type = 'purchase'"""),
    "increment_run": Query(increment_run, preparation.prepared_sql(
        f"SELECT {RESULT_COLUMNS_SQL}, max({SERVED_SQL}) OVER () AS last_processed FROM enc, stats")),
    "stream_increment": Query(stream_increment, preparation.prepared_sql(f"SELECT {RESULT_COLUMNS_SQL} FROM enc, stats")),
    "stream_progress": Query(stream_progress, """
SELECT 1::BIGINT AS batches, count(*) AS input_rows, count(*) FILTER (event_type = 'click') AS kept_rows, true AS is_timed FROM events"""),
    "stream_window": Query(stream_window, f"""
WITH spread AS (SELECT *, event_type <> 'error' AS ok, date_trunc('second', ts) - to_seconds(s) AS window_start FROM events, range(30) r(s)),
tails AS (SELECT window_start, {', '.join(f"max(CASE WHEN rn = least((n * {p}) // 100 + 1, n) THEN value END) AS p{p}_latency" for p in (95, 99))}
  FROM (SELECT window_start, value, row_number() OVER (PARTITION BY window_start ORDER BY value) AS rn, count(*) OVER (PARTITION BY window_start) AS n
    FROM spread WHERE ok AND value IS NOT NULL) GROUP BY 1)
SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, count(*) AS total, count(*) FILTER (ok) AS successful,
  (count(*) FILTER (ok) * 100) / count(*) AS success_rate,
  sum(value::DECIMAL(28,6)) FILTER (ok)::DOUBLE / nullif(count(*) FILTER (ok), 0) AS avg_latency, max(value) FILTER (ok) AS max_latency,
  any_value(p95_latency) AS p95_latency, any_value(p99_latency) AS p99_latency
FROM spread LEFT JOIN tails USING (window_start)
GROUP BY window_start HAVING window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 MINUTE FROM events)"""),
    "daily_state_range": Query(daily_state_range, DAILY_STATE_SQL),
    "stream_latest": Query(stream_latest, """
SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
}
