"""Feature view, request resolution, sanitising, encoding, scaling on literal rows."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom import schemas
from riskloom.operators import prep, requests as rq
from riskloom.plans import features as pf
from riskloom.sources import scratch

CUSTOMERS = [
    ("k1", "A", "B", 24, "M", 0, 2, 649, "CA"), ("k2", "A", "B", 66, "F", 41, 0, 750, "TX"), ("k3", "A", "B", 40, "M", 10, 0, 700, "NY")]
POLICIES = [
    ("p1", "k1", "Ford", "F-150", 2020, "Red", 1000, 2.0, "Diesel", "CVT", "Basic", 250, 10.10, 500.0, "2024-01-01", "2024-01-01 00:00:00"),
    ("p2", "k1", "BMW", "X3", 2023, "Red", 3001, 2.0, "Diesel", "CVT", "Basic", 500, 20.25, 900.0, "2024-01-01", "2024-02-01 00:00:00"),
    ("p3", "nobody", "BMW", "X3", 2023, "Red", 3001, 2.0, "Diesel", "CVT", "Basic", 500, 20.25, 900.0, "2024-01-01", "bad date")]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)


@pytest.fixture(scope="module")
def policies(spark):
    return spark.createDataFrame(POLICIES, schemas.POLICIES)


@pytest.fixture(scope="module")
def features(people, policies):
    return pf.customer_risk_features(people, policies, year=2024, as_of="2024-03-01 00:00:00")


def test_feature_view(features):
    got = {r.customer_id: r for r in features.collect()}
    assert set(got) == {"k1", "k2", "k3"}
    k1, k2 = got["k1"], got["k2"]
    assert (k1.total_policies, k1.avg_car_age, k1.avg_kilometers, k1.total_car_value, k1.avg_deductible) == (2, 2.5, 2001.0, 30.35, 375.0)
    assert (k1.risk_score, k1.credit_tier, k1.avg_claims_per_year) == (105.1, "Poor", 2.0)
    assert (k2.total_policies, k2.avg_car_age, k2.total_car_value, k2.risk_score) == (0, None, None, 20.0)


def test_spine_and_input_contract(people, policies, features):
    spine = pf.training_spine(policies, people, year=2024)
    assert spine.count() == 2 and spine.schema["ts"].dataType.typeName() == "timestamp_ntz"
    inputs = pf.inference_input(policies, people, features, year=2024)
    assert inputs.columns == fv.MODEL_INPUT_COLS and inputs.count() == 2


def test_refresh_touches_changed_customers_only(people, policies, features):
    fresh = pf.refreshed_features(people, policies.withColumn("updated_at", F.col("updated_at").try_cast("timestamp_ntz")),
                                  since="2024-01-15 00:00:00", year=2024, as_of="2024-03-01 00:00:00")
    assert fresh.collect() == features.filter("customer_id = 'k1'").collect()


def test_refresh_history(spark, people, policies, features):
    path = scratch.new_folder(spark, "history")
    timed = policies.withColumn("updated_at", F.col("updated_at").try_cast("timestamp_ntz"))
    early = pf.customer_risk_features(people, policies.filter("policy_id = 'p1'"), year=2024, as_of="2024-01-10 00:00:00")
    assert pf.refresh_table(path, early, as_of=datetime(2024, 1, 10)) == 3
    late = pf.refreshed_features(people, timed, since="2024-01-10 00:00:00", year=2024, as_of="2024-03-01 00:00:00")
    for _ in range(2):
        assert pf.refresh_table(path, late, as_of=datetime(2024, 3, 1)) == 1
    now = {r.customer_id: r.total_policies for r in pf.current_features(spark, path).collect()}
    assert now == {"k1": 2, "k2": 0, "k3": 0}
    spine = spark.createDataFrame([(i, "k1", t) for i, t in enumerate([datetime(2024, 1, 5), datetime(2024, 2, 1), datetime(2024, 3, 1)])],
                                  "i int, customer_id string, ts timestamp_ntz")
    got = {r.i: r.total_policies for r in pf.enriched_spine(spine, pf.feature_history(spark, path)).collect()}
    assert got == {0: None, 1: 1, 2: 2}


def request(i, customer_id):
    return (i, customer_id, 3, 30000, 2.0, 25000.0, 35, 17, "Toyota", "Camry", "Gasoline", "Automatic", "Standard", "M", "CA")


def test_resolution(spark, features):
    df = spark.createDataFrame([request(1, None), request(2, ""), request(3, "zzz"), request(4, "k1"), request(5, "k2")], schemas.REQUESTS)
    got = {r.request_id: r for r in rq.resolve_requests(df, features).collect()}
    assert [got[i].customer_type for i in range(1, 6)] == ["new", "new", "new", "existing", "existing"]
    for i in (1, 2, 3):
        r = got[i]
        assert (r.age, r.claims_history, r.credit_score, r.risk_score, r.avg_claims_per_year) == (35, 0, 700, 23.0, 0.0)
        assert (r.total_policies, r.avg_car_age, r.avg_kilometers, r.total_car_value, r.avg_deductible) == (0, 3.0, 30000.0, 25000.0, 500.0)
    assert (got[4].age, got[4].risk_score) == (24, 105.1)
    assert (got[5].age, got[5].avg_car_age, got[5].customer_id) == (66, None, "k2")
    clean = {r.request_id: r for r in rq.sanitized_inputs(rq.resolve_requests(df, features), ("request_id",)).collect()}
    assert (clean[5].avg_car_age, clean[5].avg_kilometers, clean[5].total_car_value, clean[5].avg_deductible) == (3.0, 30000, 25000.0, 500)


def test_sanitize_absent_columns(spark):
    r = rq.sanitized_inputs(spark.createDataFrame([("x", "7", float("nan"))], "car_model string, kilometers string, total_car_value double")).first()
    assert (r.car_model, r.kilometers, r.avg_kilometers, r.total_car_value, r.car_make, r.age) == ("x", 7, 7, 25000.0, "Toyota", 30)


def test_response_shapes(spark):
    payloads = ['{"data": [[0, {"PREDICTED_PREMIUM": 1.5}]]}', '{"data": [[0, 2]]}', '{"data": [{"PREDICTED_PREMIUM": 3}]}', '{"data": [["4"]]}',
                '{"data": []}', '{"other": 1}', 'not json', '{"data": [[0, null]]}', '{"data": [[0, {"X": 1}]]}', None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    good, bad = rq.parsed_responses(df, "p")
    assert {r.i: r.predicted_premium for r in good.collect()} == {0: 1.5, 1: 2.0, 2: 3.0, 3: 4.0}
    assert sorted(r.i for r in bad.collect()) == [4, 5, 6, 7, 8, 9]


def test_encoder_missing_unknown_and_order(spark):
    df = spark.createDataFrame([("b",), ("B",), ("é",), (None,)], "c string")
    encoder = prep.fit_encoder(df, ["c"])
    other = spark.createDataFrame([("b",), ("nope",), (None,), ("B",)], "c string")
    got = [(r.c, r.c_encoded, r.c_unknown) for r in prep.encode(other, encoder, flag_unknown=True).collect()]
    assert got == [("b", 2, False), ("nope", 0, True), (None, 1, False), ("B", 0, False)]


def test_encoder_many_classes_in_order(spark):
    names = [f"customer-with-a-long-common-beginning-{i}" for i in range(3000)] + ["", "é", "zz", "A"]
    df = spark.createDataFrame([(n,) for n in names * 2], "c string")
    encoder = prep.fit_encoder(df, ["c"])
    got = {r.c: r.c_encoded for r in prep.encode(df, encoder).distinct().collect()}
    assert got == {n: i for i, n in enumerate(sorted(set(names), key=str.encode))}


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (None, 5.0), (float("nan"), 5.0)], "x double, c double")
    scaler = prep.fit_scaler(df, ["x", "c"])
    mean, std = scaler.stats["x"]
    assert mean == pytest.approx(7 / 3) and std == pytest.approx(math.sqrt(14 / 9)) and scaler.stats["c"] == (5.0, 0.0)
    rows = prep.scale(df, scaler).collect()
    assert rows[0].x == pytest.approx((1 - 7 / 3) / std) and [r.c for r in rows] == [0.0] * 5
    assert rows[3].x is None and math.isnan(rows[4].x)


def test_contract(spark):
    df = spark.createDataFrame([(1, "a")], "age long, state string")
    problems = schemas.contract_problems(df, schemas.MODEL_INPUT)
    assert "missing column car_age" in problems and not any(p.startswith(("age", "state")) for p in problems)
    assert schemas.contract_problems(df, schemas.infer_contract(df)) == []
    assert schemas.contract_problems(df, schemas.infer_contract(df.select(F.col("age").cast("int"), "state"))) == ["age is bigint, not int"]
    with pytest.raises(ValueError, match="missing columns"):
        schemas.conform(df, schemas.MODEL_INPUT)


def test_kept_inputs_are_not_copied_through_the_class_joins(spark):
    rows = [(1, "a", 5.0), (2, "b", 6.0), (None, None, None)]
    df = spark.createDataFrame(rows, "id int, car_make string, engine_size double")
    encoder = prep.fit_encoder(df, ["car_make"])
    scaler = prep.fit_scaler(prep.encode(df, encoder), ["engine_size", "car_make_encoded"])
    out = prep.transform(df, encoder, scaler, {"kept_id": "id", "kept_make": "car_make", "kept_size": "engine_size"})
    assert out.columns == ["kept_id", "kept_make", "kept_size", "engine_size", "car_make_encoded"]
    assert {r[:3] for r in out.collect()} == set(rows)
    under = out._jdf.queryExecution().analyzed().toString().split("Join")[1]
    assert under.count("car_make") and "kept_make" not in under and "_keep_car_make" not in under
    same = prep.transform(df.select("car_make", "engine_size"), encoder, scaler, {"again": "engine_size"})
    assert sorted(r["engine_size"] for r in same.where("again is not null").collect()) == [-1.0, 1.0]
