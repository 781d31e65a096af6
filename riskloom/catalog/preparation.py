"""Label codes, scaling, splits, the model transform, generation: queries and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.catalog import Query
from riskloom.catalog import relational as rel
from riskloom.catalog import sql as q
from riskloom.functions.numeric import rounded
from riskloom.operators import prep, statistics as st
from riskloom.plans import sql_functions
from riskloom.sources import generate, serving_log, tables, views as v
from riskloom.sources.scratch import new_folder

YEAR = v.YEAR
CAR_TEXTS = ["car_make", "car_model", "fuel_type", "transmission", "coverage_type"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def encode_labels(spark, d):
    return prep.class_codes(v.vehicles(spark, d), CAR_TEXTS)


def encode_unknown(spark, d):
    encoder = prep.fit_encoder(v.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("size")), ["size"])
    sizes = v.table(spark, d, "part").select("p_partkey", F.col("p_size").alias("size"))
    return prep.encode(sizes, encoder, flag_unknown=True)


def scale_features(spark, d):
    lines = v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    scaled = prep.scale(lines, prep.fit_scaler(lines, LINE_NUMBERS))
    return scaled.withColumns({c: rounded(c, 6) for c in LINE_NUMBERS})


def scaler_fit(spark, d):
    return prep.scaler_stats(v.table(spark, d, "lineitem"), LINE_NUMBERS).select(
        *[F.round(f"{c}_{s}", 9).alias(f"{c}_{s}") for c in LINE_NUMBERS for s in ("mean", "std")])


def frozen_inputs(spark, d):
    """The model input as a written dataset: fitting and transforming read it several times."""
    root = new_folder(spark, "inputs")
    tables.write_dataset(rel.inference_input(spark, d), root, "inputs", "v1")
    return tables.read_dataset(spark, root, "inputs", "v1")


def fitted_preparation(inputs):
    encoder = prep.fit_encoder(inputs)
    return encoder, prep.fit_scaler(prep.encode(inputs, encoder), fv.MODEL_FEATURE_COLS)


def model_transform(spark, d):
    inputs = frozen_inputs(spark, d)
    encoder, scaler = fitted_preparation(inputs)
    return prep.transform(inputs, encoder, scaler, ("policy_id",)).withColumns(
        {c: rounded(c, 6) for c in fv.MODEL_FEATURE_COLS})


def transform_object(spark, d):
    inputs = frozen_inputs(spark, d)
    encoder, scaler = fitted_preparation(inputs)
    t = prep.transform_struct(inputs, encoder, scaler)
    return t.select("policy_id", *[rounded(F.col("t")[c], 6).alias(f"{c}_t") for c in fv.MODEL_FEATURE_COLS])


def sql_text_functions(spark, d):
    """The serving log read and transformed by SQL text alone."""
    inputs = frozen_inputs(spark, d)
    transform = sql_functions.register_transform(spark, *fitted_preparation(inputs), name="riskloom_transform")
    log = serving_log.capture(inputs.withColumn(fv.PREDICTION_COL, F.col("estimated_car_value")), query_id=F.col("policy_id"), at=q.AS_OF, function_name="Predict")
    late = log.withColumn("timestamp", F.timestamp_add("DAY", F.lit(3), F.col("timestamp")))
    rows = sql_functions.register_log(spark, log.unionByName(late), name="riskloom_log")
    found = spark.sql(f"""
SELECT policy_id, t.* FROM (SELECT query_id AS policy_id, {transform}({', '.join(fv.MODEL_INPUT_COLS)}) AS t
  FROM {rows}(TIMESTAMP_NTZ'2024-01-30 00:00:00', TIMESTAMP_NTZ'{q.AS_OF}', 'predict'))""")
    return found.withColumns({c: rounded(c, 6) for c in fv.MODEL_FEATURE_COLS})


def prepared_sql(select: str) -> str:
    codes = {
        f"codes_{c}": f"SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {c} AS value FROM input)"
        for c in fv.CATEGORICAL_COLS}
    joins = " ".join(f"JOIN codes_{c} ON codes_{c}.value = input.{c}" for c in fv.CATEGORICAL_COLS)
    encoded = ", ".join(f"codes_{c}.code AS {c}_encoded" for c in fv.CATEGORICAL_COLS)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fv.MODEL_FEATURE_COLS)
    return q.with_(
        select, **q.FEATURED, input=q.MODEL_INPUT, **codes, enc=f"SELECT input.*, {encoded} FROM input {joins}",
        stats=f"SELECT {stats} FROM enc")


def z(c: str) -> str:
    return q.rounded(f"({c} - m_{c}) / (CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END)", 6)


def linear_score():
    return F.lit(900.0) + F.col("estimated_car_value") * 0.02 + F.col("deductible") * 0.1


def regression_metrics(spark, d):
    scored = prep.with_split(v.policies(spark, d), "policy_id").withColumn("score", linear_score())
    return st.regression_metrics(scored, ["split"], "annual_premium", "score")


def generate_customers(spark, d):
    return generate.generate_customers(v.table(spark, d, "customer").select(F.col("c_custkey").alias("id")))


def generate_policies(spark, d):
    return generate.generate_policies(
        v.table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), v.customers(spark, d), year=YEAR, as_of=q.AS_OF)


def scoring_batch(spark, d):
    ids = v.table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return generate.scoring_batch(ids, v.customers(spark, d), year=YEAR)


def customers_sql(key: str = "'customer:' || id") -> str:
    s = fv.SEED
    return f"""
SELECT {q.padded('CUST_', 'id', 6)} AS customer_id, {q.choice(s, 'k', 6, fv.FIRST_NAMES)} AS first_name,
  {q.choice(s, 'k', 7, fv.LAST_NAMES)} AS last_name, age, {q.choice(s, 'k', 8, fv.GENDERS)} AS gender,
  greatest(1, least(age - 16, trunc({q.exponential(s, 'k', 4, 15.0)})::BIGINT)) AS years_licensed,
  least(trunc({q.exponential(s, 'k', 5, 0.8)})::BIGINT, 10) AS claims_history,
  greatest(300, least(850, trunc({q.normal(s, 'k', 2, 700.0, 80.0)})::BIGINT)) AS credit_score,
  {q.choice(s, 'k', 9, fv.STATES)} AS state
FROM (SELECT *, greatest(18, least(80, trunc({q.normal(s, 'k', 0, 42.0, 15.0)})::BIGINT)) AS age
  FROM (SELECT c_custkey AS id, {key.replace('id', 'c_custkey')} AS k FROM customer))"""


def vehicle_sql(seed: int, luxury: bool) -> str:
    models = " ".join(
        f"WHEN '{make}' THEN ({q.text_list(names)})[{q.hashed(seed, 'k', 5)} % {len(names)} + 1]" for make, names in fv.CAR_MAKES.items())
    usual = q.weighted(seed, "k", 7, fv.FUEL_TYPES, fv.FUEL_WEIGHTS)
    fine = q.weighted(seed, "k", 7, fv.FUEL_TYPES, fv.FUEL_WEIGHTS_LUXURY)
    fuel = f"CASE WHEN car_make = 'Tesla' THEN 'Electric' {f'WHEN car_make IN {tuple(fv.LUXURY_MAKES)} THEN {fine}' if luxury else ''} ELSE {usual} END"
    return f"""
SELECT *, CASE car_make {models} END AS car_model,
  trunc(greatest(1000.0e0, ({YEAR} - car_year) * {q.normal(seed, 'k', 8, 15000.0, 5000.0)} + {q.normal(seed, 'k', 10, 0.0, 5000.0)}))::BIGINT AS kilometers,
  ({q.choice(seed, 'k', 12, fv.ENGINE_SIZES)})::DOUBLE AS engine_size, {fuel} AS fuel_type,
  {q.weighted(seed, 'k', 13, fv.TRANSMISSIONS, fv.TRANSMISSION_WEIGHTS)} AS transmission,
  {q.choice(seed, 'k', 14, fv.COVERAGE_TYPES)} AS coverage_type
FROM (SELECT *, {q.choice(seed, 'k', 4, list(fv.CAR_MAKES))} AS car_make,
    {fv.FIRST_CAR_YEAR} + {q.below(seed, 'k', 6, YEAR - fv.FIRST_CAR_YEAR + 1)} AS car_year,
    {q.below(seed, 'k', 0, '(SELECT count(*) FROM customers)')} AS position FROM ids)"""


NUMBERED = "SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS position FROM customers"
VALUE = q.value_of("car_make", f"{YEAR} - car_year", "kilometers")

QUERIES: dict[str, Query] = {
    "encode_labels": Query(encode_labels, q.with_("\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", value, (row_number() OVER (ORDER BY value) - 1)::INTEGER AS code FROM (SELECT DISTINCT {c} AS value FROM vehicles)"
        for c in CAR_TEXTS), vehicles=q.VEHICLES)),
    "encode_unknown": Query(encode_unknown, """
WITH codes AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT l_linenumber::VARCHAR AS value FROM lineitem))
SELECT p_partkey, p_size AS size, coalesce(code, 0)::INTEGER AS size_encoded, code IS NULL AS size_unknown
FROM part LEFT JOIN codes ON value = p_size::VARCHAR"""),
    "scale_features": Query(scale_features, f"""
WITH stats AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in LINE_NUMBERS)} FROM lineitem)
SELECT l_orderkey, l_linenumber, {', '.join(f'{z(c)} AS {c}' for c in LINE_NUMBERS)} FROM lineitem, stats"""),
    "scaler_fit": Query(scaler_fit, "SELECT " + ", ".join(
        f"{q.rounded(f'avg({c})', 9)} AS {c}_mean, {q.rounded(f'stddev_pop({c})', 9)} AS {c}_std" for c in LINE_NUMBERS) + " FROM lineitem"),
    "model_transform": Query(model_transform, prepared_sql(
        f"SELECT policy_id, {', '.join(f'{z(c)} AS {c}' for c in fv.MODEL_FEATURE_COLS)} FROM enc, stats")),
    "sql_text_functions": Query(sql_text_functions, prepared_sql(
        f"SELECT policy_id, {', '.join(f'{z(c)} AS {c}' for c in fv.MODEL_FEATURE_COLS)} FROM enc, stats")),
    "transform_object": Query(transform_object, prepared_sql(
        f"SELECT policy_id, {', '.join(f'{z(c)} AS {c}_t' for c in fv.MODEL_FEATURE_COLS)} FROM enc, stats")),
    "regression_metrics": Query(regression_metrics, q.with_(f"""
SELECT split, count(*) AS n, {q.rounded('sqrt(avg(e * e))', 2)} AS rmse, {q.rounded('avg(abs(e))', 2)} AS mae,
  {q.rounded('1 - sum(e * e) / (count(*) * var_pop(annual_premium))', 4)} AS r2
FROM (SELECT annual_premium, annual_premium - (900e0 + estimated_car_value * 0.02e0 + deductible * 0.1e0) AS e,
  CASE WHEN {q.in_test(fv.SEED, 'policy_id')} THEN 'test' ELSE 'train' END AS split FROM policies) GROUP BY split""", **q.PRICED)),
    "generate_customers": Query(generate_customers, customers_sql()),
    "generate_policies": Query(generate_policies, q.with_(f"""
SELECT {q.padded('POL_', 'id', 7)} AS policy_id, customer_id, car_make, car_model, car_year, color, kilometers, engine_size, fuel_type,
  transmission, coverage_type, deductible, {q.rounded('raw', 2)} AS estimated_car_value,
  {q.rounded(q.premium('raw', ' + noise'), 2)} AS annual_premium,
  strftime(TIMESTAMP '{q.AS_OF}' - to_days(days::INTEGER), '%Y-%m-%d') AS policy_start_date, '{q.AS_OF}' AS updated_at
FROM (SELECT *, {VALUE} AS raw, ({q.choice(fv.SEED, 'k', 15, fv.DEDUCTIBLES)})::BIGINT AS deductible,
    {q.choice(fv.SEED, 'k', 16, fv.COLORS)} AS color, {q.below(fv.SEED, 'k', 17, 366)} AS days,
    {q.normal(fv.SEED, 'k', 18, 0.0, 50.0)} AS noise
  FROM cars JOIN numbered USING (position))""", customers=q.CUSTOMERS, numbered=NUMBERED,
        ids="SELECT o_orderkey AS id, 'policy:' || o_orderkey AS k FROM orders", cars=vehicle_sql(fv.SEED, True))),
    "scoring_batch": Query(scoring_batch, q.with_(f"""
SELECT id, customer_id, car_make, car_model, {YEAR} - car_year AS car_age, kilometers, engine_size, fuel_type, transmission,
  coverage_type, {q.rounded(VALUE, 2)} AS estimated_car_value, {q.choice(99, 'k', 15, fv.GENDERS)} AS gender, {q.choice(99, 'k', 16, fv.STATES)} AS state
FROM cars JOIN (SELECT customer_id, position FROM numbered) USING (position)""", customers=q.CUSTOMERS, numbered=NUMBERED,
        ids="SELECT l_orderkey * 10 + l_linenumber AS id, 'score:' || (l_orderkey * 10 + l_linenumber) AS k FROM lineitem",
        cars=vehicle_sql(99, False))),
}
