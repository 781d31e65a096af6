"""Merged daily states against the rows themselves."""

import random

import pytest

from riskloom.operators import daily

PERCENTS = {"p50": 50, "p95": 95, "p99": 99}


def rows():
    draw = random.Random(5)
    out = []
    for i in range(6000):
        value = draw.choice([draw.lognormvariate(3, 2), -draw.lognormvariate(0, 1), 0.0, 2.0 ** draw.randrange(-9, 30), 1e-12])
        group = ["a", "a", "a", "b", None][i % 5]
        out.append((group, f"2024-01-{1 + draw.randrange(9):02d} {draw.randrange(24):02d}:00:00", value, f"u{draw.randrange(900)}"))
    return out + [("a", None, 5.0, "u1"), ("a", "2024-01-02 00:00:00", None, None), ("b", "2024-01-03 00:00:00", float("nan"), ""),
                  ("b", "2024-01-03 00:00:00", float("inf"), "u2"), ("only", "2024-01-04 00:00:00", None, "u1")]


def frame(spark, data):
    return spark.createDataFrame(data, "g string, t string, v double, q string").selectExpr("g", "CAST(t AS TIMESTAMP) AS ts", "v", "q")


def states(spark, data):
    return daily.daily_states(frame(spark, data), ts="ts", value="v", distinct="q", by=("g",))


def test_merged_states_against_rows(spark):
    data = rows()
    # Two batches that both bring rows of every day.
    kept = states(spark, data[::2]).unionByName(states(spark, data[1::2])).cache()
    got = {r.g: r for r in daily.merged_states(kept, PERCENTS, by=("g",), since="2024-01-02", until="2024-01-07").collect()}
    inside = [r for r in data if r[1] and "2024-01-02" <= r[1][:10] <= "2024-01-07"]
    assert set(got) == {"a", "b", None, "only"}
    for group, r in got.items():
        mine = [x for x in inside if x[0] == group]
        values = sorted(x[2] for x in mine if x[2] is not None and abs(x[2]) < float("inf"))
        assert (r.n_rows, r.n) == (len(mine), len(values))
        seen = len({x[3] for x in mine if x[3]})
        assert abs(r.distinct - seen) <= max(1, daily.DISTINCT_ERROR * seen)
        if not values:
            assert (r["mean"], r.lo, r.hi, r.p50, r.p99) == (None,) * 5
            continue
        assert (r.lo, r.hi) == (values[0], values[-1]) and r["mean"] == pytest.approx(sum(values) / len(values), abs=1e-6)
        for name, p in PERCENTS.items():
            want = values[min(len(values) * p // 100, len(values) - 1)]
            assert abs(r[name] - want) <= daily.RELATIVE_ERROR * abs(want) + 2.0 ** -daily.LOWEST


def test_a_range_is_the_sum_of_its_parts(spark):
    data = rows()
    whole = daily.merged_states(states(spark, data), PERCENTS, by=("g",)).collect()
    parts = daily.merged_states(states(spark, data[:100]).unionByName(states(spark, data[100:])), PERCENTS, by=("g",)).collect()
    exact = [[str({**r.asDict(), "distinct": None}) for r in side] for side in (whole, parts)]
    assert sorted(exact[0]) == sorted(exact[1])
    seen = [{r.g: r.distinct for r in side} for side in (whole, parts)]
    assert all(abs(seen[0][g] - seen[1][g]) <= 2 * daily.DISTINCT_ERROR * seen[0][g] for g in seen[0])


def test_no_groups_no_rows_no_days(spark):
    data = rows()
    total = daily.merged_states(daily.daily_states(frame(spark, data), ts="ts", value="v", distinct="q"), PERCENTS).collect()
    assert len(total) == 1 and total[0].n_rows == len(data) - 1
    assert daily.merged_states(states(spark, data), PERCENTS, by=("g",), since="2030-01-01").count() == 0
    assert states(spark, []).count() == 0
