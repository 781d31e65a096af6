"""Registry, gate, expiry, model fit and the whole flow."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom import schemas
from riskloom.functions import rating
from riskloom.plans import flow, registry, scoring
from riskloom.sources import generate, tables
from riskloom.sources.scratch import new_folder

NOW = datetime(2024, 1, 31)


def gate(spark, production, score, threshold=0.7):
    """production: None, or the metric of the promoted version ('missing' for none recorded)."""
    events = []
    if production is not None:
        metrics = {} if production == "missing" else {"test_r2": production}
        events = [("m", "p", "register", metrics, None, None, NOW), ("m", "p", "promote", None, None, None, NOW)]
    candidates = spark.createDataFrame([("m", "c", score)], "model string, version string, score double")
    return registry.gate_decisions(candidates, spark.createDataFrame(events, schemas.MODEL_EVENTS), threshold=threshold).first().decision


@pytest.mark.parametrize("production,score,decision", [
    (None, 0.1, "promote_model"), (None, None, "promote_model"), (0.8, 0.69, "send_alert"), (0.6, 0.69, "send_alert"),
    (0.8, 0.8, "promote_model"), (0.8, 0.79, "send_alert"), ("missing", 0.7, "promote_model"), (0.8, None, "send_alert")])
def test_gate(spark, production, score, decision):
    assert gate(spark, production, score) == decision


def test_registry_life(spark):
    r = registry.Registry(spark, new_folder(spark, "registry"))
    day = lambda n: NOW - timedelta(days=n)
    assert r.default("m") is None and r.check("m", "a", {"test_r2": 0.1}) == "promote_model"
    r.register("m", "a", {"test_r2": 0.8}, artifact_path="/a", comment="first", at=day(30))
    r.register("m", "b", {"test_r2": 0.9}, at=day(7))
    r.register("m", "c", {"test_r2": 0.9}, at=day(8))
    r.register("other", "z", {"test_r2": 0.9}, at=day(100))
    with pytest.raises(ValueError):
        r.register("m", "a", {})
    with pytest.raises(ValueError):
        r.promote("m", "nope")
    r.promote("m", "b", at=day(3))
    r.promote("m", "a", at=day(2))
    assert r.default("m")["version"] == "a" and r.default("m")["artifact_path"] == "/a"
    assert r.check("m", "x", {"test_r2": 0.79}) == "send_alert" and r.check("m", "x", {"test_r2": 0.8}) == "promote_model"
    r.set_metrics("m", "b", {"test_r2": 0.5}, at=day(1))
    assert r.version("m", "b").first().metrics == {"test_r2": 0.5}
    # A metric set alone leaves the others.
    r.set_metrics("m", "a", {"rmse": 3.0}, at=day(1))
    assert r.version("m", "a").first().metrics == {"test_r2": 0.8, "rmse": 3.0}
    assert r.check("m", "x", {"test_r2": 0.75}) == "send_alert" and r.check("m", "x", {"test_r2": float("nan")}) == "send_alert"
    # The old default stays, the version exactly at the cutoff stays, a model without default keeps all.
    assert r.expire(as_of=NOW, days=7) == 1
    assert sorted((v.model, v.version) for v in r.versions().collect()) == [("m", "a"), ("m", "b"), ("other", "z")]
    assert r.expire(as_of=NOW, days=7) == 0


def test_version_name_and_alert(spark):
    assert spark.range(1).select(registry.version_name(datetime(2024, 1, 31, 23, 59, 58))).first()[0] == "v_20240131_235958"
    path = new_folder(spark, "alerts")
    message = registry.send_alert(spark, path, "v1", {"test_r2": 0.5}, at=NOW)
    row = spark.read.parquet(path).first()
    assert row.message == message and '"test_r2": 0.5' in message and (row.alert_type, row.alert_time) == ("MODEL_QUALITY", NOW)


@pytest.fixture(scope="module")
def generated(spark):
    customers = generate.generate_customers(generate.ids(spark, 400)).cache()
    policies = generate.generate_policies(generate.ids(spark, 1500), customers, year=2024, as_of=NOW).cache()
    return customers, policies


def test_generated_domains(generated):
    customers, policies = generated
    c = customers.agg(F.min("age"), F.max("age"), F.min("years_licensed"), F.max(F.col("years_licensed") - F.col("age") + 16),
                      F.max("claims_history"), F.min("credit_score"), F.max("credit_score"), F.count_distinct("customer_id")).first()
    assert c[0] >= 18 and c[1] <= 80 and c[2] >= 1 and c[3] <= 0 and c[4] <= 10 and c[5] >= 300 and c[6] <= 850 and c[7] == 400
    p = policies.agg(F.min("annual_premium"), F.max("annual_premium"), F.min("kilometers"), F.count_distinct("policy_id"), F.min("car_year"), F.max("car_year")).first()
    assert p[0] >= 400 and p[1] <= 5000 and p[2] >= 1000 and p[3] == 1500 and (p[4], p[5]) == (2010, 2024)
    assert policies.join(customers, "customer_id", "left_anti").count() == 0
    assert policies.filter("car_make = 'Tesla' AND fuel_type <> 'Electric'").count() == 0
    assert schemas.contract_problems(customers, schemas.CUSTOMERS) == [] and schemas.contract_problems(policies, schemas.POLICIES) == []
    models = {r.car_make: set(r.m) for r in policies.groupBy("car_make").agg(F.collect_set("car_model").alias("m")).collect()}
    assert all(found <= set(fv.CAR_MAKES[make]) for make, found in models.items())


def test_generation_does_not_depend_on_partitions(spark):
    a = generate.generate_customers(generate.ids(spark, 50)).collect()
    b = generate.generate_customers(generate.ids(spark, 50).repartition(5)).orderBy("customer_id").collect()
    assert a == b


def test_ids_are_not_broadcast_to_the_rows_they_pick(spark):
    known = generate.generate_customers(generate.ids(spark, 60)).select("customer_id")
    owned = generate.linked(generate.ids(spark, 900).union(spark.createDataFrame([(7,)], "id long")), known, "policy", 42)
    rows = owned.collect()
    assert "SortMergeJoin" in owned._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(rows) == 901 and len({r.id for r in rows}) == 900 and len({r.customer_id for r in rows}) == 60


def test_flow_promotes_then_alerts(spark, generated):
    customers, policies = generated
    root = new_folder(spark, "flow")
    run = lambda day, threshold: flow.run_flow(
        spark, root, customers, policies, year=2024, as_of=NOW + timedelta(days=day), rounds=6, depth=4, threshold=threshold)
    first = run(0, 0.7)
    assert first["decision"] == "promote_model" and first["predictions"] == 1500 and set(first["metrics"]) == {
        "train_r2", "train_rmse", "train_mae", "test_r2", "test_rmse", "test_mae"}
    at = flow.Layout(root)
    spread = spark.read.parquet(at.predictions).agg(F.min("predicted_premium"), F.max("predicted_premium"), F.count_distinct("policy_id")).first()
    assert spread[0] >= 400 and spread[1] <= 5000 and spread[2] == 1500
    second = run(10, 2.0)
    assert second["decision"] == "send_alert" and spark.read.parquet(at.alerts).count() == 1
    assert registry.Registry(spark, at.registry).default(flow.MODEL_NAME)["version"] == first["version"]
    assert sorted(r.state for r in spark.read.parquet(at.runs).collect()) == ["SUCCEEDED", "SUCCEEDED"]

    model = scoring.load_model(spark, at.model(first["version"]))
    assert model.metrics == first["metrics"]
    training = tables.read_dataset(spark, at.datasets, "premium_training", first["version"])
    a = model.run(training, "predict", ("policy_id",)).agg(F.sum("predicted_premium")).first()[0]
    b = scoring.load_model(spark, at.model(first["version"])).predict(training, ("policy_id",)).agg(F.sum("predicted_premium")).first()[0]
    assert a == pytest.approx(b)
    assert model.run(training, "transform").columns == fv.MODEL_FEATURE_COLS
    with pytest.raises(ValueError):
        model.run(training, "explain")
    assert model.importances().count() == 22 and [f.name for f in scoring.model_contract(spark, at.model(first["version"]))[0]] == fv.MODEL_INPUT_COLS
    sample = scoring.sample_contract(training)
    assert "predicted_premium" in sample["output"] and '"car_age"' in sample["input"]


def test_expiry_removes_artifacts(spark):
    folder = new_folder(spark, "artifacts")
    r = registry.Registry(spark, f"{folder}/registry")
    for name, age in (("old", 30), ("new", 1)):
        spark.range(1).write.parquet(f"{folder}/{name}")
        r.register("m", name, {"test_r2": 0.8}, artifact_path=f"{folder}/{name}", at=NOW - timedelta(days=age))
    r.promote("m", "new", at=NOW)
    assert r.expire(as_of=NOW, days=7) == 1
    assert not tables.exists(spark, f"{folder}/old") and tables.exists(spark, f"{folder}/new")


def test_unknown_age_is_not_eligible(spark):
    df = spark.createDataFrame([(None, 5), (30, 5), (30, 15), (90, 60)], "age long, y long")
    rows = df.select(rating.eligible_years("age").alias("most"), rating.eligible("age", "y").alias("ok")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (14, True), (14, False), (60, True)]
