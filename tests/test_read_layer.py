"""The forecast optimiser, the guard of asked queries, expected groups and gaps, previews, header rows."""

import datetime as dt
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from macrolake import schemas
from macrolake.operators import forecast, quality, serving
from macrolake.sources import landed

# --- forecasts ----------------------------------------------------------------------------------


def followed(y, x, season=12):
    """Sum of squared one-step errors by the plain recursion; x is weights, level, trend, all season values but the last."""
    a, b, c, level, trend = x[:5]
    seasonals = [*x[5:], -sum(x[5:])]
    total = 0.0
    for t, value in enumerate(y):
        s = seasonals[t % season]
        base = level + trend
        total += (value - base - s) ** 2
        new = a * (value - s) + (1 - a) * base
        trend = b * (new - level) + (1 - b) * trend
        level, seasonals[t % season] = new, c * (value - base) + (1 - c) * s
    return total


def simulated(seed, n, a, b, c, noise):
    draw = np.random.default_rng(seed)
    level, trend, seasonals, y = 100.0, 0.5, [10 * np.sin(i) for i in range(12)], []
    for t in range(n):
        e = draw.normal(0, noise)
        y.append(level + trend + seasonals[t % 12] + e)
        new = level + trend + a * e
        trend = b * (new - level) + (1 - b) * trend
        level, seasonals[t % 12] = new, seasonals[t % 12] + c * e
    return y


SERIES = [simulated(i, n, *w, noise) for i, (n, w, noise) in enumerate([
    (120, (0.5, 0.1, 0.2), 1.0), (120, (0.9, 0.05, 0.05), 5.0), (60, (0.2, 0.3, 0.6), 0.5), (24, (0.5, 0.5, 0.5), 2.0),
    (200, (1.0, 0.0, 0.0), 1.0), (36, (0.0, 0.0, 0.0), 3.0), (80, (0.3, 0.0, 1.0), 1.0),
])]


def fitted(series, steps=forecast.STEPS):
    return forecast._grid_search(12, forecast.GRID, steps)(pd.Series(series))


def test_optimised_fit_is_never_above_the_grid_and_mostly_below():
    grid, best = fitted(SERIES, 0), fitted(SERIES)
    assert (best.sse <= grid.sse).all() and (best.sse < 0.97 * grid.sse).sum() >= 5
    assert best[["alpha", "beta", "gamma"]].to_numpy().min() >= 0 and best[["alpha", "beta", "gamma"]].to_numpy().max() <= 1


@pytest.mark.parametrize("k", range(len(SERIES)))
def test_other_minimisers_find_nothing_better(k):
    """For given weights the best starting states solve a linear system; the weights are searched finely on their own."""
    y = np.array(SERIES[k])

    def by_weights(w):
        zero = np.zeros(13)
        errors = lambda x: _errors(y, [*w, *x])
        at_zero = errors(zero)
        matrix = np.stack([errors(unit) - at_zero for unit in np.eye(13)], axis=1)
        x, *_ = np.linalg.lstsq(matrix, -at_zero, rcond=None)
        return followed(y, [*w, *x])

    best = fitted([SERIES[k]]).iloc[0]
    own = by_weights((best.alpha, best.beta, best.gamma))
    assert best.sse <= own * (1 + 1e-6) + 1e-9  # the states are the best for these weights
    draw = np.random.default_rng(k)
    near = np.clip(np.array([best.alpha, best.beta, best.gamma]) + draw.normal(0, 0.02, (30, 3)), 0, 1)
    assert min(map(by_weights, near)) >= best.sse * (1 - 1e-4) - 1e-9


def _errors(y, x, season=12):
    a, b, c, level, trend = x[:5]
    seasonals, out = [*x[5:], -sum(x[5:])], []
    for t, value in enumerate(y):
        s = seasonals[t % season]
        base = level + trend
        out.append(value - base - s)
        new = a * (value - s) + (1 - a) * base
        trend = b * (new - level) + (1 - b) * trend
        level, seasonals[t % season] = new, c * (value - base) + (1 - c) * s
    return np.array(out)


def test_optimised_fit_gives_the_same_bits_in_any_batch():
    together = fitted(SERIES + SERIES[::-1])
    for i, series in enumerate(SERIES):
        alone = fitted([series]).iloc[0]
        for other in (together.iloc[i], together.iloc[len(together) - 1 - i]):
            assert all(np.array_equal(alone[c], other[c]) for c in together.columns)
    assert len(fitted([])) == 0


@pytest.mark.parametrize("rows", [{"SLOPE_ROWS": 1}, {"SLOPE_ROWS": 5, "GRID_ROWS": 2}, {"SERIES_AT_ONCE": 3}])
def test_optimised_fit_gives_the_same_bits_in_blocks_of_any_size(monkeypatch, rows):
    series = SERIES + [simulated(100 + i, 60, 0.3, 0.2, 0.4, 1.0) for i in range(4)] + [[7.0] * 48]
    whole = fitted(series)
    for name, n in rows.items():
        monkeypatch.setattr(forecast, name, n)
    blocks = fitted(series)
    assert all(np.array_equal(p, q) for c in whole.columns for p, q in zip(whole[c], blocks[c]))


def test_descent_costs_a_small_multiple_of_the_grid_search():
    """CPU time against the grid search of the same series: measured 20 times, and 71 times with derivatives taken at every trial step."""
    series = [simulated(i, 84, 0.3, 0.1, 0.2, 2.0) for i in range(300)]

    def seconds(steps):
        start = time.process_time()
        fitted(series, steps)
        return time.process_time() - start

    assert min(seconds(forecast.STEPS) for _ in range(2)) < 40 * min(seconds(0) for _ in range(2))


def test_optimised_fit_in_spark(spark):
    months = pd.date_range("2000-01-01", periods=240, freq="MS").date
    rows = [(f"s{i}", months[t], float(v)) for i, y in enumerate(SERIES) for t, v in enumerate(y)] + [("short", months[0], 1.0)]
    actuals = spark.createDataFrame(rows, "indicator string, obs_month date, value double")
    fits = {r.indicator: r for r in forecast.hw_fit_optimised(actuals).collect()}
    want = fitted(SERIES)
    assert set(fits) == {f"s{i}" for i in range(len(SERIES))}
    assert all(fits[f"s{i}"].sse == want.sse[i] and fits[f"s{i}"].seasonals == want.seasonals[i].tolist() for i in range(len(SERIES)))
    line = [(("l"), m, 50.0 + 3.0 * i + [0, 5, -2, 1][i % 4] * 1.0) for i, m in enumerate(months[:48])]
    ahead = forecast.hw_forecast(forecast.hw_fit_optimised(spark.createDataFrame(line, actuals.schema))).orderBy("obs_month").collect()
    assert np.allclose([r.yhat for r in ahead], [50.0 + 3.0 * i + [0, 5, -2, 1][i % 4] for i in range(48, 54)], atol=0.02)


# --- asked queries ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def gold():
    def relations(session):
        rows = [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 2, 1), 2.0)]
        mart = session.createDataFrame(rows, "obs_month date, usdthb double")
        return {"fx_monthly": mart, "dashboard_monthly": mart.withColumn("policy_rate", F.lit(2.5))}

    return relations


@pytest.mark.parametrize(
    "statement,rows",
    [
        ("SELECT count(*) FROM gold.fx_monthly", [(2,)]),
        ("select f.usdthb from fx_monthly f join gold . dashboard_monthly d using (obs_month) where d.policy_rate > 1 order by 1", [(1.0,), (2.0,)]),
        ("with a as (select max(usdthb) m from gold.fx_monthly) select m, (select min(usdthb) from `gold`.`fx_monthly`) from a", [(2.0, 1.0)]),
        ("select 'gold.fx_monthly', \"gold.fx_monthly\" -- gold.fx_monthly\n, 'it\\'s gold.fx_monthly' from gold.fx_monthly limit 1", [("gold.fx_monthly", "gold.fx_monthly", "it's gold.fx_monthly")]),
        ("select usdthb, row_number() over (order by usdthb desc) from fx_monthly where obs_month in (select obs_month from gold.dashboard_monthly) union all select 0, 0 order by 1", [(0.0, 0), (1.0, 2), (2.0, 1)]),
        ("select m from (select usdthb, array(1, 2) as a from fx_monthly) lateral view explode(a) t as m where usdthb = 1", [(1,), (2,)]),
    ],
)
def test_questions_over_gold_are_answered(spark, gold, statement, rows):
    assert [tuple(r) for r in serving.guarded_gold_query(spark, statement, gold).collect()] == rows


@pytest.mark.parametrize(
    "statement",
    [
        "SELECT * FROM payroll",
        "SELECT * FROM global_temp.payroll",
        "SELECT * FROM wages",
        "SELECT * FROM default.wages",
        "select * from (select * from default.wages) as fx_monthly",
        "with fx_monthly as (select * from default.wages) select * from fx_monthly",
        "select usdthb from gold.fx_monthly where usdthb in (select x from default.wages)",
        "select (select max(x) from wages) from gold.fx_monthly",
        "select * from default.fx_monthly_view",
        "select * from range(3)",
        "select * from values (1), (2)",
        "select reflect('java.lang.System', 'getenv') from gold.fx_monthly",
        "select usdthb from fx_monthly where java_method('java.util.UUID', 'randomUUID') is not null",
        "select try_reflect('java.lang.System', 'getenv')",
        "select input_file_name() from fx_monthly",
        "select transform(usdthb) using 'cat' as (x) from fx_monthly",
        "select shout(usdthb) from fx_monthly",
        "with a as (select 1) merge into default.wages using a on false when not matched then values (1)",
        "select * from parquet.`/tmp`",
    ],
)
def test_other_relations_and_code_are_rejected(spark, gold, statement):
    spark.createDataFrame([("ann", 1), ("bob", 2)], "name string, x int").createOrReplaceTempView("payroll")
    spark.table("payroll").createOrReplaceGlobalTempView("payroll")
    spark.sql("CREATE TABLE IF NOT EXISTS default.wages USING parquet AS SELECT 1 AS x")
    spark.sql("CREATE OR REPLACE VIEW default.fx_monthly_view AS SELECT * FROM default.wages")
    spark.udf.register("shout", lambda x: str(x))
    try:
        with pytest.raises(Exception) as error:
            serving.guarded_gold_query(spark, statement, gold).collect()
        assert isinstance(error.value, serving.UnsafeStatement) or error.value.getCondition() in ("UNRESOLVED_ROUTINE", "PARSE_SYNTAX_ERROR")
    finally:
        spark.sql("DROP VIEW default.fx_monthly_view")
        spark.sql("DROP TABLE default.wages")


def test_the_callers_views_and_settings_stay(spark, gold):
    spark.range(7).createOrReplaceTempView("fx_monthly")
    before = spark.conf.get("spark.sql.runSQLOnFiles"), spark.conf.get("spark.sql.session.timeZone")
    answer = serving.guarded_gold_query(spark, "select count(*) as n from fx_monthly", gold)
    assert answer.first().n == 2 and spark.table("fx_monthly").count() == 7
    assert (spark.conf.get("spark.sql.runSQLOnFiles"), spark.conf.get("spark.sql.session.timeZone")) == before
    assert answer.sparkSession.conf.get("spark.sql.session.timeZone") == before[1]
    spark.catalog.dropTempView("fx_monthly")


# --- expected groups and gaps -------------------------------------------------------------------


def test_absent_groups_fail(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), ("extra", 4.0)], "indicator string, value double")
    expected = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "indicator string, _rows int")
    rules = [quality.exact_rows(2), quality.min_rows(1), quality.not_null("value"), quality.min_distinct("value", 3), quality.not_null("gone")]
    got = {(r.indicator, r.rule, r.column_name): (r.n_rows, r.n_failed, r.passed) for r in quality.dq_report(rows, "s", rules, ["indicator"], expected).collect()}
    assert len(got) == 20
    assert got["b", "exact_rows", None] == (0, 2, False) and got["b", "min_rows", None] == (0, 1, False)
    assert got["b", "not_null", "value"] == (0, 0, True) and got["b", "min_distinct", "value"] == (0, 3, False)
    assert got["b", "not_null", "gone"] == (0, None, False)
    assert got["a", "exact_rows", None] == (2, 0, True) and got[None, "exact_rows", None] == (1, 1, False) and got["extra", "min_rows", None][2]
    with pytest.raises(quality.DataQualityError):
        quality.dq_enforce(quality.dq_report(rows, "s", [quality.min_rows(1)], ["indicator"], expected))
    dated = rows.limit(0).withColumn("d", F.lit(None).cast("date"))
    none = quality.dq_report(dated, "s", [quality.fresh("d", "2024-01-01", 1)], ["indicator"], expected).collect()
    assert sorted((r.indicator or "", r.n_failed) for r in none) == [("", 1), ("a", 1), ("b", 1)]


def test_month_gaps(spark):
    rows = [("a", "2020-01-31"), ("a", "2020-02-01"), ("a", "2020-02-15"), ("a", "2020-06-30"), ("a", "2021-01-01"), ("b", "2020-01-01"), ("c", None)]
    frame = spark.createDataFrame(rows, "k string, d string").select("k", F.col("d").cast("date").alias("d"))
    got = sorted(map(tuple, quality.month_gaps(frame, ["k"], "d").collect()))
    assert got == [("a", dt.date(2020, 3, 1), dt.date(2020, 5, 1), 3), ("a", dt.date(2020, 7, 1), dt.date(2020, 12, 1), 6)]


# --- previews -----------------------------------------------------------------------------------


def test_a_preview_reads_once_and_stores_nothing(spark, tmp_path, monkeypatch):
    path, scratch = str(tmp_path / "t"), tmp_path / "scratch"
    spark.range(1000).repartition(5).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(count, "id long")
    got = serving.preview_with_total(rows, ["id"], 3).collect()
    assert [tuple(r) for r in got] == [(0, 1000), (1, 1000), (2, 1000)]
    assert read.value == 1000 and not scratch.exists()
    assert serving.preview_with_total(spark.range(0), ["id"]).collect() == []


# --- header rows --------------------------------------------------------------------------------

QUOTES = """Price,Close,High,Volume
Ticker,^SET.BK,^SET.BK,^SET.BK
Date,,,
2024-01-02,1433.38,1440.0,9000
2024-01-03,1430.5,,0
"""


def written(tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"q{i}.csv").write_text(text)
    return str(tmp_path)


def test_quotes_with_two_header_rows(spark, tmp_path):
    more = QUOTES.replace("2024-01-0", "2024-02-0").replace("9000", "7000")
    rows = landed.read_with_header_rows(spark, written(tmp_path, QUOTES, more), schema=schemas.QUOTES)
    assert rows.columns == ["Date", "Close|^SET.BK", "High|^SET.BK", "Volume|^SET.BK"]
    assert rows.schema["Close|^SET.BK"].dataType.simpleString() == "double"
    got = sorted(map(tuple, landed.normalize_ohlc(rows).collect()))
    assert got == [(dt.date(2024, 1, 2), 1433.38, 9000.0), (dt.date(2024, 2, 2), 1433.38, 7000.0)]


def test_header_rows_without_a_label_row(spark, tmp_path):
    rows = landed.read_with_header_rows(spark, written(tmp_path, "Date,Close,Volume\n,X,X\n2024-01-02,1.5,3\n"), schema=schemas.QUOTES)
    assert [tuple(r) for r in rows.collect()] == [(dt.date(2024, 1, 2), 1.5, 3.0)]


@pytest.mark.parametrize("bad", ["2024-01-04,abc,1,2\n", "not a day,1,1,2\n", "2024-01-04,1,1,2,9\n", "2024-01-04,1\n"])
def test_bad_rows_below_header_rows_are_errors(spark, tmp_path, bad):
    rows = landed.read_with_header_rows(spark, written(tmp_path, QUOTES + bad), schema=schemas.QUOTES)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|MALFORMED|FAILED_READ_FILE"):
        rows.collect()


def test_missing_header_rows_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="header rows"):
        landed.read_with_header_rows(spark, written(tmp_path, "Price,Close\n"), schema=schemas.QUOTES)
    os.makedirs(tmp_path / "twice")
    with pytest.raises(ValueError, match="twice"):
        landed.read_with_header_rows(spark, written(tmp_path / "twice", "Price,Close,Close\nTicker,X,X\nDate,,\n"))
