"""Column helpers on literal edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.functions import draws, numeric, rating, text, times
from riskloom.sources.serving_log import json_attribute, object_of

NAN, INF = float("nan"), float("inf")


def column(spark, values, kind, make):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def same(a, b):
    return len(a) == len(b) and all((x == y) or (isinstance(x, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))


def test_clamp(spark):
    got = column(spark, [399.99, 400.0, 5000.0, 5000.01, NAN, None], "double", lambda c: numeric.clamp(c, 400.0, 5000.0))
    assert same(got, [400.0, 400.0, 5000.0, 5000.0, NAN, None])


def test_safe_int(spark):
    assert column(spark, [None, "12", " 7 ", "12.5", "abc", "", "nan"], "string", lambda c: numeric.safe_int(c, 9)) == [9, 12, 7, 9, 9, 9, 9]
    assert column(spark, [None, NAN, INF, 12.7, -0.5, -3.9], "double", lambda c: numeric.safe_int(c, 9)) == [9, 9, 9, 12, 0, -3]


def test_safe_float(spark):
    got = column(spark, [None, "12", "12.5", "abc", "", "NaN", "1.5d", "2f", "inf", "1e3"], "string", lambda c: numeric.safe_float(c, 1.25, text=True))
    assert got == [1.25, 12.0, 12.5, 1.25, 1.25, 1.25, 1.25, 1.25, INF, 1000.0]
    assert column(spark, [None, NAN, -0.5], "double", lambda c: numeric.safe_float(c, 2.0)) == [2.0, 2.0, -0.5]


def test_text_or_and_lookup(spark):
    assert column(spark, [None, "", "x"], "string", lambda c: numeric.text_or(c, "d")) == ["d", "d", "x"]
    assert column(spark, ["Ford", "Lada", None], "string", lambda c: numeric.lookup(fv.MAKE_FACTORS, c, 1.0)) == [1.1, 1.0, 1.0]
    with pytest.raises(Exception, match="unknown key"):
        column(spark, ["Gold"], "string", lambda c: numeric.lookup(fv.COVERAGE_FACTORS, c, strict=True))


def test_rounded(spark):
    got = column(spark, [0.285, 1.005, 89.15499999999999, -2.5, NAN, None], "double", lambda c: numeric.rounded(c, 2))
    assert same(got, [0.29, 1.01, 89.16, -2.5, NAN, None])


def test_null_keeping_bounds(spark):
    assert column(spark, [-1, 5, None], "int", lambda c: numeric.at_least(0, c)) == [0, 5, None]
    assert column(spark, [-1, 5, None], "int", lambda c: numeric.at_most(0, c)) == [-1, 0, None]
    assert column(spark, [0, 4, None], "int", lambda c: numeric.ratio(F.lit(8), c)) == [0.0, 2.0, 0.0]


def test_keys_and_labels(spark):
    assert column(spark, [1, 999999, 12345678], "long", text.customer_key) == ["CUST_000001", "CUST_999999", "CUST_12345678"]
    assert column(spark, ["CUST_000001 - A B (3y, CA)", "plain"], "string", text.key_of_label) == ["CUST_000001", "plain"]
    assert column(spark, [1234.5, 0.125, 9999999.999], "double", text.money_text) == ["$1,234.50", "$0.13", "$10,000,000.00"]


def test_rating_bounds(spark):
    rows = spark.createDataFrame(
        [(24, 0, 0, 649), (25, 41, 0, 650), (65, 1, 2, 699), (66, 10, 1, 750)], "age int, y int, c int, s int")
    got = rows.select(rating.risk_score("age", "y", "c", "s"), rating.credit_tier("s"), rating.claims_per_year("c", "y")).collect()
    assert [tuple(r) for r in got] == [
        (75.1, "Poor", 0.0), (5.0, "Fair", 0.0), (69.1, "Fair", 2.0), (65.0, "Excellent", 0.1)]


def test_premium_every_make_and_bounds(spark):
    makes = [*fv.CAR_MAKES, "Lada"]
    rows = spark.createDataFrame(
        [(m, c, 20, 0, 3, 600, 90000.0, 250) for m in makes for c in fv.COVERAGE_TYPES] + [("Ford", "Basic", 40, 44, 0, 850, 100.0, 2000)],
        "m string, c string, age int, y int, h int, s int, v double, d int")
    got = rows.select("m", "c", rating.annual_premium("age", "y", "h", "s", "m", "v", "c", "d").alias("p")).collect()
    for r in got[:-1]:
        raw = 800 * 1.5 * 1.3 * 1.45 * 1.3 * 1.27 * fv.MAKE_FACTORS.get(r.m, 1.0) * fv.COVERAGE_FACTORS[r.c] * 1.2
        assert r.p == pytest.approx(max(400, min(5000, raw)))
    assert got[-1].p == 400.0


def test_car_value(spark):
    rows = spark.createDataFrame([("Ford", 0, 0), ("Lada", 1, 600000)], "m string, a int, km long")
    assert [round(r[0], 6) for r in rows.select(rating.car_value("m", "a", "km")).collect()] == [35000.0, 12750.0]


def test_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.000900' AS a, TIMESTAMP_NTZ'2024-03-10 03:10:00.001100' AS b, "
                     "TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS c")
    seen = []
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        r = rows.select(times.epoch_micros("a"), times.millis_between("a", "b"), times.time_cell("b", 3600), times.epoch_micros("c"),
                        times.time_cell("c", 10)).first()
        seen.append(tuple(r))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(seen) == {(1710037800000900, 2400001, 475011, -500000, -1)}


def test_millisecond_boundaries(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.000900' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:00.001100' AS b")
    assert rows.select(times.millis_between("a", "b")).first()[0] == 1


def test_draws_are_stable_and_uniform(spark):
    frame = draws.with_digests(spark.range(20000), 7, "id", 4)
    u = draws.uniform(3)
    a = frame.select(F.sum(u), F.min(u), F.max(u)).first()
    b = frame.repartition(13).select(F.sum(u), F.min(u), F.max(u)).first()
    assert a[1:] == b[1:] and a[0] == pytest.approx(b[0]) and a[0] / 20000 == pytest.approx(0.5, abs=0.02)
    z = frame.select(F.avg(draws.normal(0, 10.0, 2.0)), F.stddev(draws.normal(0, 10.0, 2.0))).first()
    assert z[0] == pytest.approx(10, abs=0.1) and z[1] == pytest.approx(2, abs=0.1)
    share = frame.filter(draws.in_test_split(42, "id")).count() / 20000
    assert share == pytest.approx(0.2, abs=0.02)


def test_json_attributes(spark):
    rows = spark.createDataFrame([('{"a.b.c": 3, "a": {"b": {"c": 9}}, "n": null}',)], "j string")
    got = rows.select(json_attribute("j", "a.b.c"), json_attribute("j", "n"), json_attribute("j", "zz")).first()
    assert tuple(got) == ("3", None, None)
    assert rows.select(object_of(A=F.lit(1), B=F.lit(None).cast("int"))).first()[0] == '{"A":1}'
