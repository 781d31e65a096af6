"""The feature view from signed changes against a full computation."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from riskloom.plans import features, incremental
from riskloom.sources.scratch import new_folder

POLICY = "policy_id string, customer_id string, car_year long, kilometers long, deductible long, estimated_car_value double"


def policy(draw, i):
    gap = lambda v: None if draw.random() < 0.1 else v
    return (f"P{i}", f"C{draw.choice([0, 0, 0, 1, 2, 3, 4, 5])}", gap(draw.randrange(2010, 2024)), gap(draw.randrange(1000, 90000)),
            gap(draw.choice([250, 500])), gap(draw.randrange(100, 9_000_000) / 100))


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(f"C{i}", 20 + i * 9, i, i % 3, 600 + i * 20) for i in range(8)],
                                 "customer_id string, age long, years_licensed long, claims_history long, credit_score long")


def view(df):
    return sorted(df.drop("updated_at").collect(), key=lambda r: r.customer_id)


def test_changes_add_up_to_the_full_view(spark, customers):
    draw = random.Random(5)
    frame = lambda rows: spark.createDataFrame(rows, POLICY)
    rows = {f"P{i}": policy(draw, i) for i in range(60)}
    sums = incremental.FeatureSums(spark, new_folder(spark, "sums"))
    sums.apply(incremental.changes(added=frame(list(rows.values()))), "load")
    current = {r.customer_id: r for r in view(sums.features(customers, year=2024))}
    for step in range(4):
        old = draw.sample(sorted(rows), 8)
        gone, moved = old[:4], old[4:]
        removed = [rows[k] for k in old]
        added = [(*rows[k][:1], *policy(draw, 0)[1:]) for k in moved] + [policy(draw, 100 + 10 * step + j) for j in range(3)]
        if step == 2:  # the whole of one customer goes
            removed += [r for k, r in rows.items() if r[1] == "C5" and k not in old]
        for r in removed:
            del rows[r[0]]
        rows |= {r[0]: r for r in added}
        touched = sums.apply(incremental.changes(added=frame(added), removed=frame(removed)), f"step {step}")
        assert {r.customer_id for r in touched.collect()} == {r[1] for r in added + removed}
        current |= {r.customer_id: r for r in view(sums.features(customers, year=2024, keys=touched))}
        if step == 1:
            assert sums.compact() == 3 and sums.drop_unlisted() == 3
    full = view(features.customer_risk_features(customers, frame(list(rows.values())), year=2024))
    assert sorted(current.values(), key=lambda r: r.customer_id) == full == view(sums.features(customers, year=2024))
    assert any(r.total_policies == 0 and r.avg_car_age is None for r in full)
    # Another year needs no other sums.
    assert view(sums.features(customers, year=2031)) == view(features.customer_risk_features(customers, frame(list(rows.values())), year=2031))


def test_a_change_counts_once(spark, customers):
    draw = random.Random(6)
    rows = spark.createDataFrame([policy(draw, i) for i in range(10)], POLICY)
    path = new_folder(spark, "sums")
    incremental.FeatureSums(spark, path)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda _: incremental.FeatureSums(spark, path).apply(incremental.changes(added=rows), "load"), range(3)))
    sums = incremental.FeatureSums(spark, path)
    sums.compact()
    sums.apply(incremental.changes(added=rows), "load")
    assert view(sums.features(customers, year=2024)) == view(features.customer_risk_features(customers, rows, year=2024))
    assert sums.drop_unlisted() == 1 and sums.sums().count() > 0


def test_a_refresh_reads_no_policies(spark, customers):
    draw = random.Random(7)
    path = new_folder(spark, "policies")
    spark.createDataFrame([policy(draw, i) for i in range(20)], POLICY).write.parquet(path)
    sums = incremental.FeatureSums(spark, new_folder(spark, "sums"))
    sums.apply(incremental.changes(added=spark.read.parquet(path)), "load")
    touched = sums.apply(incremental.changes(added=spark.createDataFrame([policy(draw, 99)], POLICY)), "one")
    out = sums.features(customers, year=2024, keys=touched)
    assert not any(path in f for f in out.inputFiles()) and out.count() == touched.count() == 1
    with pytest.raises(ValueError):
        incremental.FeatureSums(spark, new_folder(spark, "sums")).sums()
