"""Scans, projections, joins, aggregates, sorting: queries and SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.catalog import Query
from riskloom.catalog import sql as q
from riskloom.functions import rating
from riskloom.functions.numeric import rounded, truncate_to_int
from riskloom.functions.text import customer_label, key_of_label
from riskloom.functions.times import format_time, instant, millis_between, shift
from riskloom.functions import draws
from riskloom.operators import latest, requests as rq, statistics as st
from riskloom.plans import features as pf
from riskloom.sources import tables, views as v

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
YEAR = v.YEAR


def features_of(spark: SparkSession, d: str) -> DataFrame:
    return pf.customer_risk_features(v.customers(spark, d), v.vehicles(spark, d), year=YEAR, as_of=q.AS_OF)


def customer_risk_features(spark: SparkSession, d: str) -> DataFrame:
    return features_of(spark, d)


def features_with_no_history(spark, d):
    return pf.customer_risk_features(v.prospects(spark, d), v.vehicles(spark, d), year=YEAR, as_of=q.AS_OF)


def car_value(spark, d):
    age = rating.car_age("car_year", YEAR)
    return v.vehicles(spark, d).select(
        "policy_id", "car_make", "estimated_car_value",
        rounded(rating.car_value(F.lit("Other"), age, "kilometers"), 2).alias("unlisted_make_value"))


def premium_rating(spark, d):
    return v.policies(spark, d).select(
        "policy_id", "annual_premium", rounded(rating.monthly_instalment("annual_premium"), 2).alias("monthly_premium"))


def training_spine(spark, d):
    return pf.training_spine(v.policies(spark, d), v.customers(spark, d), year=YEAR, keep=("policy_id",))


def inference_input(spark, d):
    return pf.inference_input(v.vehicles(spark, d), v.customers(spark, d), features_of(spark, d), year=YEAR, keep=("policy_id",))


def resolve_existing_new(spark, d):
    return rq.resolve_requests(v.requests(spark, d), features_of(spark, d)).select(
        "request_id", "customer_type", "customer_id", "age", "years_licensed", "claims_history", "credit_score",
        "risk_score", "avg_claims_per_year", "credit_tier", "total_policies", "avg_car_age", "avg_kilometers",
        "total_car_value", "avg_deductible")


RESOLVE_SQL = q.with_(f"""
SELECT r.request_id, CASE WHEN f.customer_id IS NULL THEN 'new' ELSE 'existing' END AS customer_type, r.customer_id,
  CASE WHEN f.customer_id IS NULL THEN r.age ELSE f.age END AS age,
  CASE WHEN f.customer_id IS NULL THEN r.years_licensed ELSE f.years_licensed END AS years_licensed,
  CASE WHEN f.customer_id IS NULL THEN 0 ELSE f.claims_history END AS claims_history,
  CASE WHEN f.customer_id IS NULL THEN 700 ELSE f.credit_score END AS credit_score,
  CASE WHEN f.customer_id IS NULL THEN {q.risk('r.age', 'r.years_licensed', '0', '700')} ELSE f.risk_score END AS risk_score,
  CASE WHEN f.customer_id IS NULL THEN 0e0 ELSE f.avg_claims_per_year END AS avg_claims_per_year,
  CASE WHEN f.customer_id IS NULL THEN 'Good' ELSE f.credit_tier END AS credit_tier,
  CASE WHEN f.customer_id IS NULL THEN 0 ELSE f.total_policies END AS total_policies,
  CASE WHEN f.customer_id IS NULL THEN r.car_age ELSE f.avg_car_age END::DOUBLE AS avg_car_age,
  CASE WHEN f.customer_id IS NULL THEN r.kilometers ELSE f.avg_kilometers END::DOUBLE AS avg_kilometers,
  CASE WHEN f.customer_id IS NULL THEN r.estimated_car_value ELSE f.total_car_value END AS total_car_value,
  CASE WHEN f.customer_id IS NULL THEN 500 ELSE f.avg_deductible END::DOUBLE AS avg_deductible
FROM requests r LEFT JOIN features f ON r.customer_id = f.customer_id""", **q.FEATURED, requests=q.REQUESTS)


def quote_inputs(spark, d):
    resolved = rq.resolve_requests(v.requests(spark, d), pf.customer_risk_features(
        v.prospects(spark, d), v.vehicles(spark, d), year=YEAR, as_of=q.AS_OF))
    return rq.sanitized_inputs(resolved, ("request_id", "customer_type"))


QUOTE_INPUTS_SQL = q.with_(f"""
SELECT r.request_id, CASE WHEN f.customer_id IS NULL THEN 'new' ELSE 'existing' END AS customer_type,
  r.car_age, r.kilometers, r.engine_size, r.estimated_car_value,
  coalesce(f.age, r.age) AS age, coalesce(f.years_licensed, r.years_licensed) AS years_licensed,
  coalesce(f.claims_history, 0) AS claims_history, coalesce(f.credit_score, 700) AS credit_score,
  coalesce(f.risk_score, {q.risk('r.age', 'r.years_licensed', '0', '700')}) AS risk_score,
  coalesce(f.avg_claims_per_year, 0e0) AS avg_claims_per_year, coalesce(f.total_policies, 0) AS total_policies,
  coalesce(f.avg_car_age, r.car_age)::DOUBLE AS avg_car_age,
  coalesce(f.avg_kilometers, r.kilometers)::BIGINT AS avg_kilometers,
  coalesce(f.total_car_value, r.estimated_car_value) AS total_car_value,
  coalesce(f.avg_deductible, 500)::BIGINT AS avg_deductible,
  r.car_make, r.car_model, r.fuel_type, r.transmission, r.coverage_type, r.gender, r.state
FROM requests r LEFT JOIN features f ON r.customer_id = f.customer_id""",
    people=q.PROSPECTS, vehicles=q.VEHICLES, features=q.features("people", "vehicles"), requests=q.REQUESTS)


def sanitize_requests(spark, d):
    k = F.get_json_object("props", "$.k")
    raw = v.table(spark, d, "events").select(
        "event_id",
        k.alias("car_age"),
        F.col("value").cast("string").alias("kilometers"),
        F.col("event_type").alias("engine_size"),
        F.col("value").cast("string").alias("estimated_car_value"),
        F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")).alias("age"),
        F.lit(None).cast("string").alias("years_licensed"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(k).alias("claims_history"),
        F.col("value").alias("credit_score"),
        F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value")).alias("risk_score"),
        F.when(F.col("event_type") == "view", F.lit("NaN")).otherwise(k).alias("avg_car_age"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("car_make"),
        F.when(F.col("event_type") != "click", F.concat(k, F.lit("d"))).alias("total_car_value"))
    return rq.sanitized_inputs(raw, ("event_id",))


SANITIZE_SQL = """
SELECT event_id, k::BIGINT AS car_age, 0::BIGINT AS kilometers, 2.0e0 AS engine_size, value AS estimated_car_value,
  user_id AS age, 10::BIGINT AS years_licensed,
  CASE WHEN event_type = 'error' THEN 0 ELSE k END::BIGINT AS claims_history,
  trunc(value)::BIGINT AS credit_score,
  CASE WHEN event_type = 'view' THEN 0e0 ELSE value END AS risk_score,
  0e0 AS avg_claims_per_year, 0::BIGINT AS total_policies, k::DOUBLE AS avg_car_age,
  0::BIGINT AS avg_kilometers, value AS total_car_value, 500::BIGINT AS avg_deductible,
  CASE WHEN event_type = 'error' THEN 'Toyota' ELSE event_type END AS car_make, 'Camry' AS car_model,
  'Gasoline' AS fuel_type, 'Automatic' AS transmission, 'Standard' AS coverage_type, 'M' AS gender, 'CA' AS state
FROM (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events)"""


def response_payload(spark, d):
    x = F.col("value").cast("string")

    def shape(before: str, after: str):
        return F.concat(F.lit(before), x, F.lit(after))

    payload = (
        F.when(F.col("event_type") == "click", shape('{"data": [[0, {"PREDICTED_PREMIUM": ', "}]]}"))
        .when(F.col("event_type") == "view", shape('{"data": [[0, ', "]]}"))
        .when(F.col("event_type") == "signup", shape('{"data": [{"PREDICTED_PREMIUM": ', "}]}"))
        .when(F.col("event_type") == "purchase", shape('{"data": [[', "]]}"))
        .otherwise(F.lit('{"data": []}')))
    good, bad = rq.parsed_responses(v.table(spark, d, "events").select("event_id", payload.alias("payload")), "payload")
    return good.select("event_id", fv.PREDICTION_COL, F.lit("parsed").alias("outcome")).unionByName(
        bad.select("event_id", F.lit(None).cast("double").alias(fv.PREDICTION_COL), F.lit("rejected").alias("outcome")))


def point_lookup(spark, d):
    return rq.lookup_rows(v.customers(spark, d), "customer_id", "CUST_000007")


def known_key_semi(spark, d):
    return rq.known_only(v.requests(spark, d).select("request_id", "customer_id"), v.customers(spark, d), "customer_id")


def unknown_key_anti(spark, d):
    return rq.unknown_only(v.requests(spark, d).select("request_id", "customer_id"), v.customers(spark, d), "customer_id")


def upsert_if_absent(spark, d):
    target = v.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    source = v.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("amount"))
    return tables.insert_absent(target, source, ["id"])


def keyed_update(spark, d):
    target = v.table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", F.col("p_retailprice").alias("amount"))
    updates = v.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("amount"))
    return tables.keyed_update(target, updates, ["id"])


def describe_numeric(spark, d):
    stats = st.describe(v.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return stats.select("column", "count", *[F.round(c, 9).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


DESCRIBE_SQL = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", {q.rounded(f'avg({c})', 9)} AS mean,
  {q.rounded(f'stddev_samp({c})', 9)} AS std, {q.rounded(f'min({c})', 9)} AS "min",
  {q.rounded(f'quantile_cont({c}, 0.25)', 9)} AS q25, {q.rounded(f'quantile_cont({c}, 0.5)', 9)} AS q50,
  {q.rounded(f'quantile_cont({c}, 0.75)', 9)} AS q75, {q.rounded(f'max({c})', 9)} AS "max" FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def min_max_mean(spark, d):
    return st.min_max_mean(v.policies(spark, d), "annual_premium").withColumn("mean", F.round("mean", 9))


def status_rates(spark, d):
    return st.status_rates(v.table(spark, d, "events"), ["user_id"], F.col("event_type") != "error", 86400.0 * 30)


def category_counts(spark, d):
    return st.category_counts(v.table(spark, d, "events"), F.col("event_type") != "error", "event_type")


def error_frequency(spark, d):
    return st.error_frequency(v.table(spark, d, "documents"), "text")


def latency_histogram(spark, d):
    h = st.histogram(v.table(spark, d, "events"), "value", 20)
    return h.withColumns({c: rounded(c, 6) for c in ("bin_start", "bin_end")})


def premium_histogram(spark, d):
    h = st.histogram(v.policies(spark, d), "annual_premium", 30, 400, 5000)
    return h.withColumns({c: rounded(c, 6) for c in ("bin_start", "bin_end")})


def ordered_scan(spark, d):
    return v.customers(spark, d).select(
        "customer_id", "first_name", "last_name", "age", "gender", "years_licensed", "state").orderBy("customer_id")


def first_n_keys(spark, d):
    return latest.first_rows(v.customers(spark, d).select("customer_id"), 100, "customer_id")


def sample_limit(spark, d):
    return latest.first_rows(v.vehicles(spark, d).select("policy_id", "car_make"), 100, "policy_id")


def newest_rows(spark, d):
    return latest.newest_rows(v.table(spark, d, "events").drop("props"), 20, "ts", ("event_id",))


def table_counts(spark, d):
    counts = [v.table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in TABLES]
    return reduce(DataFrame.unionByName, counts)


def sql_text_scan(spark, d):
    return tables.read_sql(
        spark, "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity "
        "FROM {lines} WHERE l_shipdate >= CAST(:start AS TIMESTAMP_NTZ) GROUP BY l_returnflag".format(
            lines=f"parquet.`{d}/lineitem.parquet`"), start="1997-01-01 00:00:00")


def folder_scan(spark, d):
    return tables.read_folder(spark, f"{d}/orders.parquet").select("o_orderkey", "o_totalprice")


def eligibility_bound(spark, d):
    """The forties stand for customers of unknown age."""
    people = v.customers(spark, d).withColumn("age", F.when(~F.col("age").between(40, 49), F.col("age")))
    return people.select(
        "customer_id", rating.eligible_years("age").alias("most_years"), rating.eligible("age", "years_licensed").alias("is_eligible"))


def customer_labels(spark, d):
    label = customer_label("customer_id", "first_name", "last_name", "age", "state")
    return v.customers(spark, d).select(label.alias("label"), key_of_label(label).alias("label_key"))


def time_functions(spark, d):
    ts = F.col("ts")
    later = shift(ts, "SECOND", 90)
    return v.table(spark, d, "events").select(
        "event_id",
        format_time(ts, fv.DATE_FORMAT).alias("day"), format_time(ts, fv.TIMESTAMP_FORMAT).alias("stamp"),
        format_time(ts, fv.TIME_FORMAT).alias("time"), format_time(ts, fv.VERSION_FORMAT).alias("version"),
        later.alias("later"), shift(ts, "HOUR", -1).alias("hour_ago"), millis_between(ts, later).alias("waited_ms"),
        F.date_sub(ts.cast("date"), 7).cast("string").alias("week_ago"),
        (ts > instant(fv.WATERMARK_START)).alias("after_start"), truncate_to_int("value").alias("whole_value"))


def changed_key_refresh(spark, d):
    return pf.refreshed_features(
        v.customers(spark, d), v.vehicles(spark, d), since="2001-07-15 00:00:00", year=YEAR, as_of=q.AS_OF)


def hash_split(spark, d):
    split = draws.in_test_split(fv.SEED, "o_orderkey")
    return v.table(spark, d, "orders").select("o_orderkey", split.alias("is_test"))


QUERIES: dict[str, Query] = {
    "customer_risk_features": Query(customer_risk_features, q.with_("SELECT * FROM features", **q.FEATURED)),
    "features_with_no_history": Query(features_with_no_history, q.with_(
        "SELECT * FROM features", people=q.PROSPECTS, vehicles=q.VEHICLES, features=q.features("people", "vehicles"))),
    "car_value": Query(car_value, q.with_(
        f"SELECT policy_id, car_make, estimated_car_value, "
        f"{q.rounded(q.value_of(chr(39) + 'Other' + chr(39), f'{YEAR} - car_year', 'kilometers'), 2)} AS unlisted_make_value FROM vehicles",
        vehicles=q.VEHICLES)),
    "premium_rating": Query(premium_rating, q.with_(
        f"SELECT policy_id, annual_premium, {q.rounded('annual_premium / 12', 2)} AS monthly_premium FROM policies", **q.PRICED)),
    "training_spine": Query(training_spine, q.with_(f"""
SELECT p.policy_id, p.customer_id, car_make, car_model, {YEAR} - car_year AS car_age, kilometers, engine_size, fuel_type,
  transmission, coverage_type, estimated_car_value, gender, state, annual_premium, updated_at AS ts
FROM policies p JOIN customers c ON p.customer_id = c.customer_id""", **q.PRICED)),
    "inference_input": Query(inference_input, q.with_(q.MODEL_INPUT, **q.FEATURED)),
    "resolve_existing_new": Query(resolve_existing_new, RESOLVE_SQL),
    "quote_inputs": Query(quote_inputs, QUOTE_INPUTS_SQL),
    "sanitize_requests": Query(sanitize_requests, SANITIZE_SQL),
    "response_payload": Query(response_payload, """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS predicted_premium,
  CASE WHEN event_type <> 'error' THEN 'parsed' ELSE 'rejected' END AS outcome FROM events"""),
    "point_lookup": Query(point_lookup, q.with_(
        "SELECT * FROM customers WHERE customer_id = 'CUST_000007' LIMIT 1", customers=q.CUSTOMERS)),
    "known_key_semi": Query(known_key_semi, q.with_(
        "SELECT request_id, customer_id FROM requests WHERE customer_id IN (SELECT customer_id FROM customers)",
        customers=q.CUSTOMERS, requests=q.REQUESTS)),
    "unknown_key_anti": Query(unknown_key_anti, q.with_(
        "SELECT request_id, customer_id FROM requests r WHERE NOT EXISTS "
        "(SELECT 1 FROM customers c WHERE c.customer_id = r.customer_id)", customers=q.CUSTOMERS, requests=q.REQUESTS)),
    "upsert_if_absent": Query(upsert_if_absent, """
SELECT c_custkey AS id, c_acctbal AS amount FROM customer UNION ALL
SELECT p_partkey, p_retailprice FROM part WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = p_partkey)"""),
    "keyed_update": Query(keyed_update, """
SELECT p_partkey AS id, p_brand, CASE WHEN o.k IS NULL THEN p_retailprice ELSE o.amount END AS amount
FROM part LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) AS amount FROM orders GROUP BY 1) o ON o.k = p_partkey"""),
    "describe_numeric": Query(describe_numeric, DESCRIBE_SQL),
    "min_max_mean": Query(min_max_mean, q.with_(
        f'SELECT min(annual_premium) AS "min", max(annual_premium) AS "max", {q.rounded("avg(annual_premium)", 9)} AS mean FROM policies',
        **q.PRICED)),
    "status_rates": Query(status_rates, """
SELECT user_id, count(*) AS total, count(*) FILTER (event_type <> 'error') AS successful,
  count(*) FILTER (event_type = 'error') AS failed,
  (count(*) FILTER (event_type <> 'error') * 100) / count(*) AS success_rate, count(*) / 2592000e0 AS throughput
FROM events GROUP BY user_id"""),
    "category_counts": Query(category_counts, "SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1"),
    "error_frequency": Query(error_frequency, """
SELECT substring(coalesce(text, 'Unknown'), 1, 80) AS error, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, error"""),
    "latency_histogram": Query(latency_histogram, f"""
WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - lo) / (hi - lo) * 20), 19)::INTEGER AS bin, count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi
  FROM events, e GROUP BY 1)
SELECT bin, {q.rounded('lo + bin * ((hi - lo) / 20)', 6)} AS bin_start, {q.rounded('lo + (bin + 1) * ((hi - lo) / 20)', 6)} AS bin_end, n FROM b"""),
    "premium_histogram": Query(premium_histogram, q.with_(f"""
SELECT bin, {q.rounded('400 + bin * (4600e0 / 30)', 6)} AS bin_start, {q.rounded('400 + (bin + 1) * (4600e0 / 30)', 6)} AS bin_end, n
FROM (SELECT least(floor((annual_premium - 400) / 4600e0 * 30), 29)::INTEGER AS bin, count(*) AS n FROM policies GROUP BY 1)""", **q.PRICED)),
    "ordered_scan": Query(ordered_scan, q.with_(
        "SELECT customer_id, first_name, last_name, age, gender, years_licensed, state FROM customers ORDER BY customer_id",
        customers=q.CUSTOMERS)),
    "first_n_keys": Query(first_n_keys, q.with_("SELECT customer_id FROM customers ORDER BY customer_id LIMIT 100", customers=q.CUSTOMERS)),
    "sample_limit": Query(sample_limit, q.with_("SELECT policy_id, car_make FROM vehicles ORDER BY policy_id LIMIT 100", vehicles=q.VEHICLES)),
    "newest_rows": Query(newest_rows, "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20"),
    "table_counts": Query(table_counts, " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES)),
    "sql_text_scan": Query(sql_text_scan, """
SELECT l_returnflag, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1"""),
    "folder_scan": Query(folder_scan, "SELECT o_orderkey, o_totalprice FROM orders"),
    "eligibility_bound": Query(eligibility_bound, q.with_("""
SELECT customer_id, most_years, years_licensed >= 1 AND years_licensed <= most_years AS is_eligible
FROM (SELECT *, CASE WHEN age NOT BETWEEN 40 AND 49 THEN least(age - 16, 60) END AS most_years FROM customers)""",
        customers=q.CUSTOMERS)),
    "customer_labels": Query(customer_labels, q.with_("""
SELECT label, split_part(label, ' - ', 1) AS label_key FROM (
  SELECT customer_id || ' - ' || first_name || ' ' || last_name || ' (' || age || 'y, ' || state || ')' AS label FROM customers)""",
        customers=q.CUSTOMERS)),
    "time_functions": Query(time_functions, """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%H:%M:%S') AS "time",
  strftime(ts, 'v_%Y%m%d_%H%M%S') AS version, ts + INTERVAL 90 SECOND AS later, ts - INTERVAL 1 HOUR AS hour_ago,
  90000::BIGINT AS waited_ms, strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d') AS week_ago, ts > TIMESTAMP '1970-01-01' AS after_start,
  trunc(value)::BIGINT AS whole_value FROM events"""),
    "changed_key_refresh": Query(changed_key_refresh, q.with_(
        "SELECT * FROM features WHERE customer_id IN (SELECT customer_id FROM vehicles WHERE updated_at > TIMESTAMP '2001-07-15')",
        **q.FEATURED)),
    "hash_split": Query(hash_split, f"SELECT o_orderkey, {q.in_test(fv.SEED, 'o_orderkey')} AS is_test FROM orders"),
}
