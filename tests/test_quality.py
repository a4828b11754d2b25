"""Quality gates: the good and bad frame of each suite, and the report itself."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from macrolake.operators import quality as q

LAST = dt.date(2024, 7, 18)  # 200 days from 2024-01-01


def daily(spark, n=200, **columns):
    start = F.lit("2024-01-01").cast("date")
    rows = spark.range(n).withColumn("obs_date", F.date_add(start, F.col("id").cast("int")))
    return rows.select("id", "obs_date", *[F.lit(v).alias(k) for k, v in columns.items()])


def spoil(df, column, value):
    return df.withColumn(column, F.when(F.col("id") == 0, F.lit(value)).otherwise(F.col(column)))


SUITES = [
    ("set", {"set_index": 1500.0, "set_volume": 1e6}, 200, q.set_suite(LAST), "set_index", -1.0),
    ("fx", {"usdthb": 33.0}, 200, q.fx_suite(LAST), "usdthb", 99.0),
    ("policy", {"policy_rate": 1.75}, 200, q.policy_rate_suite(), "policy_rate", -1.0),
    ("cpi", {"cpi_yoy": 1.2}, 200, q.cpi_suite(), "cpi_yoy", 99.0),
    ("bond", {"bond_10y": 2.5}, 24, q.bond_suite(), "bond_10y", 264.0),
]


@pytest.mark.parametrize("name,columns,n,rules,column,bad", SUITES, ids=[s[0] for s in SUITES])
def test_suites(spark, name, columns, n, rules, column, bad):
    good = daily(spark, n, **columns)
    q.dq_enforce(q.dq_report(good, name, rules))
    with pytest.raises(q.DataQualityError) as error:
        q.dq_enforce(q.dq_report(spoil(good, column, bad), name, rules))
    assert [(r["rule"], r["column_name"], r["n_failed"]) for r in error.value.failures] == [("in_range", column, 1)]


def forecast(spark, upper0=1600.0):
    rows = [(1500.0, 1400.0, upper0), (1520.0, 1420.0, 1620.0), (1510.0, 1410.0, 1610.0)]
    return spark.createDataFrame(rows, "yhat double, yhat_lower double, yhat_upper double")


def failed(report):
    return {(r["rule"], r["column_name"]): r["n_failed"] for r in report.filter("not passed").collect()}


def test_forecast_suite(spark):
    assert failed(q.dq_report(forecast(spark), "f", q.forecast_suite(3))) == {}
    assert failed(q.dq_report(forecast(spark, 1450.0), "f", q.forecast_suite(3))) == {("band_order", "yhat"): 1}
    assert failed(q.dq_report(forecast(spark), "f", q.forecast_suite(6))) == {("exact_rows", None): 3}


def test_forecast_sanity(spark):
    actuals = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 900.0), ("A", dt.date(2024, 2, 1), 30.0)],
        "indicator string, obs_month date, value double",
    )
    ahead = spark.createDataFrame(
        [("A", 90.0, 80.0, 100.0), ("A", 90.1, 80.0, 100.0), ("A", 9.9, 0.0, 9.0), ("A", -1.0, -2.0, 0.0)],
        "indicator string, yhat double, yhat_lower double, yhat_upper double",
    )
    report = q.dq_report(q.with_last_actual(ahead, actuals), "s", q.forecast_sanity_suite(), ["indicator"])
    assert failed(report) == {("positive", "yhat"): 1, ("within_factor", "yhat"): 3, ("band_order", "yhat"): 1}


def test_null_and_nan_belong_to_not_null(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (9.0,)], "v double")
    rules = [q.not_null("v"), q.in_range("v", 0, 5), q.non_negative("v"), q.positive("v")]
    assert failed(q.dq_report(rows, "s", rules)) == {("not_null", "v"): 2, ("in_range", "v"): 1}


def test_range_ends_are_inside(spark):
    rows = spark.createDataFrame([(50.0,), (5000.0,)], "v double")
    assert failed(q.dq_report(rows, "s", [q.in_range("v", 50, 5000)])) == {}


def test_missing_or_wrong_column(spark):
    rows = spark.createDataFrame([(1,)], "v int")
    rules = [q.has_type("v", DoubleType()), q.has_type("w", DoubleType()), q.in_range("w", 0, 1)]
    assert failed(q.dq_report(rows, "s", rules)) == {("has_type", "v"): 1, ("has_type", "w"): 1, ("in_range", "w"): None}


def test_empty_input_fails_rows_and_freshness(spark):
    rows = daily(spark, 0, usdthb=33.0)
    assert failed(q.dq_report(rows, "fx", q.fx_suite(LAST))) == {("min_rows", None): 100, ("fresh", "obs_date"): 1}


def test_freshness_counts_days_beyond_the_limit(spark):
    rows = daily(spark, 200, usdthb=33.0)
    assert failed(q.dq_report(rows, "fx", q.fx_suite(LAST + dt.timedelta(14)))) == {}
    assert failed(q.dq_report(rows, "fx", q.fx_suite(LAST + dt.timedelta(16)))) == {("fresh", "obs_date"): 2}


def test_long_suite(spark):
    index = daily(spark, 120).select(F.lit("TH.SET_INDEX").alias("indicator_code"), "obs_date", F.lit(1500.0).alias("value"))
    volume = index.withColumns({"indicator_code": F.lit("TH.SET_VOLUME"), "value": F.lit(9e9)})
    last = dt.date(2024, 4, 29)
    rows = index.unionByName(volume)
    assert failed(q.dq_report(rows, "set", q.set_long_suite(last))) == {}
    few = rows.filter("obs_date < '2024-04-01'")
    assert failed(q.dq_report(few, "set", q.set_long_suite(dt.date(2024, 3, 31)))) == {("min_distinct", "obs_date"): 9}
    low = rows.withColumn("value", F.lit(49.0))
    assert failed(q.dq_report(low, "set", q.set_long_suite(last))) == {("conditional_range", "value"): 120}


def test_report_per_group(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", -1.0), ("b", 2.0)], "g string, v double")
    report = q.dq_report(rows, "s", [q.non_negative("v"), q.min_rows(2)], ["g"])
    got = {(r["g"], r["rule"]): (r["n_rows"], r["n_failed"], r["passed"]) for r in report.collect()}
    assert got == {
        ("a", "non_negative"): (2, 1, False),
        ("a", "min_rows"): (2, 0, True),
        ("b", "non_negative"): (1, 0, True),
        ("b", "min_rows"): (1, 1, False),
    }
