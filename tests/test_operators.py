"""Edge cases of the operators on small frames."""

import datetime as dt
import json
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.errors import ArithmeticException, DateTimeException, NumberFormatException
from pyspark.sql import functions as F

from macrolake import schemas
from macrolake.functions import text
from macrolake.operators import bronze, crossmart, forecast, monthly, serving, silver
from macrolake.sources import lake, landed

D = dt.date


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def obs(spark, rows):
    return spark.createDataFrame(rows, "indicator_code string, obs_date date, value double")


# --- sources ------------------------------------------------------------------------------


def test_monthly_series_rejects_malformed_text(spark):
    ok = spark.createDataFrame([("2024-03", "1.5"), ("2024-04", None)], schemas.MONTHLY_STATISTICS)
    assert tuples(landed.normalize_monthly_series(ok)) == [(D(2024, 3, 1), 1.5)]
    with pytest.raises(NumberFormatException):
        landed.normalize_monthly_series(spark.createDataFrame([("2024-03", "")], schemas.MONTHLY_STATISTICS)).collect()
    with pytest.raises(DateTimeException):
        landed.normalize_monthly_series(spark.createDataFrame([("2024/3", "1")], schemas.MONTHLY_STATISTICS)).collect()


def test_event_snapshot(spark):
    record = spark.createDataFrame([("2024-11-13 14:05:00", "2.25", None, "held")], schemas.POLICY_SNAPSHOT)
    row = landed.normalize_event_snapshot(record).first()
    assert tuple(row)[:4] == (D(2024, 11, 13), 2.25, None, "held")
    assert json.loads(row["raw"])["news_text_th"] is None


def test_drop_missing_value(spark):
    rows = spark.createDataFrame(
        [(D(2024, 1, 1), 1.0), (D(2024, 1, 2), None), (D(2024, 1, 3), float("nan")), (D(2024, 1, 4), 2.0)],
        schemas.DAILY_SERIES,
    )
    assert tuples(landed.drop_missing_value(rows)) == [(D(2024, 1, 1), 1.0), (D(2024, 1, 4), 2.0)]
    assert tuples(landed.drop_missing_value(rows, D(2024, 1, 2))) == [(D(2024, 1, 4), 2.0)]


def test_ohlc_drops_ticker_level_and_untraded_days(spark):
    quotes = spark.createDataFrame(
        [(D(2024, 1, 1), 1.0, 5.0), (D(2024, 1, 2), 2.0, 0.0), (D(2024, 1, 3), 3.0, None)],
        "`Date` date, `Close|^X.Y` double, `Volume|^X.Y` double",
    )
    assert tuples(landed.normalize_ohlc(quotes)) == [(D(2024, 1, 1), 1.0, 5.0)]


def test_optional_source_reports_other_errors(spark, tmp_path):
    assert landed.optional_source(spark, str(tmp_path / "none"), schemas.DAILY_SERIES).count() == 0
    with pytest.raises(Exception, match="(?i)data source"):
        landed.optional_source(spark, str(tmp_path), schemas.DAILY_SERIES, "no_such_format")


def test_replace_by_key_keeps_other_keys_and_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, k string"
    lake.replace_by_key(spark.createDataFrame([(1, "a"), (2, "b/c")], schema), path, "k")
    table = lake.scan_parquet(spark, path, schema)
    lake.replace_by_key(table.filter("k = 'a'").withColumn("v", F.col("v") + 10), path, "k")
    assert tuples(lake.scan_parquet(spark, path, schema)) == [(11, "a"), (2, "b/c")]


def test_truncate_load_keeps_the_declared_columns(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.createDataFrame([(Decimal("1.5"), D(2024, 1, 1))], "cpi_yoy decimal(10,2), obs_month date")
    lake.sink_truncate_load(rows, path, schemas.CPI_MONTHLY)
    assert spark.read.parquet(path).schema == schemas.CPI_MONTHLY


# --- bronze -------------------------------------------------------------------------------


def test_long_series_is_split_into_bounded_documents(spark):
    """One series holds nearly all rows; no document exceeds the part size and nothing is lost."""
    rows = spark.range(25_000).select(
        F.when(F.col("id") < 24_000, "hot").otherwise("cold").alias("series"),
        F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("obs_date"),
        F.col("id").cast("double").alias("value"),
        F.col("id").alias("pos"),
    )
    packed = bronze.pack_payload(rows, "series", ["obs_date", "value"], part_size=1000)
    sizes = packed.select(F.json_array_length(F.get_json_object("payload", "$.obs")).alias("n")).collect()
    assert len(sizes) == 25 and max(r["n"] for r in sizes) == 1000
    back = bronze.explode_payload(packed, schemas.VALUE_PAYLOAD).withColumn("order", bronze.payload_order())
    assert back.count() == 25_000
    # payload order is the order of the source
    hot = [r["value"] for r in back.filter("series_id = 'hot'").orderBy("order").collect()]
    assert hot == [float(i) for i in range(24_000)]
    with pytest.raises(ValueError):
        bronze.pack_payload(rows, "series", ["value"], part_size=1 << 21)


def test_payload_keeps_null_values(spark):
    rows = spark.createDataFrame([("s", D(2024, 1, 1), None, 0)], "series string, obs_date date, value double, pos long")
    packed = bronze.pack_payload(rows, "series", ["obs_date", "value"])
    assert json.loads(packed.first()["payload"]) == {"obs": [{"obs_date": "2024-01-01", "value": None}]}
    assert tuples(bronze.explode_payload(packed, schemas.VALUE_PAYLOAD, "series_id")) == [("s", 0, D(2024, 1, 1), None)]


def test_latest_batch_takes_all_parts_and_breaks_ties(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    raw = spark.createDataFrame(
        [("s", "b1", 0, t1), ("s", "b2", 0, t2), ("s", "b2", 1, t2), ("t", "x", 0, t1), ("t", "y", 0, t1)],
        "series_id string, batch_id string, part long, ingested_at timestamp_ntz",
    )
    assert tuples(bronze.latest_batch(raw).select("series_id", "batch_id", "part")) == [
        ("s", "b2", 0), ("s", "b2", 1), ("t", "y", 0),
    ]


# --- silver -------------------------------------------------------------------------------


def test_dedupe_last_keeps_a_last_null(spark):
    rows = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1.0, 1), ("a", D(2024, 1, 1), None, 2), ("b", D(2024, 1, 1), 3.0, 9)],
        "indicator_code string, obs_date date, value double, pos long",
    )
    assert tuples(silver.dedupe_last(rows)) == [("a", D(2024, 1, 1), None), ("b", D(2024, 1, 1), 3.0)]


SILVER = "indicator_code string, obs_date date, value double, unit string, source string, source_series_id string"


def test_upsert_changes_the_value_only(spark):
    day = [D(2024, 1, i) for i in range(1, 5)]
    target = spark.createDataFrame(
        [("a", day[0], 1.0, "u", "s", "x"), ("a", day[1], 2.0, None, "s", "x"), ("a", day[2], 3.0, "u", "s", "x")], SILVER
    )
    batch = spark.createDataFrame(
        [("a", day[1], None, "n", "n", "n"), ("a", day[2], 30.0, "n", "n", "n"), ("a", day[3], 4.0, "n", "n", "n")], SILVER
    )
    want = sorted(
        [
            ("a", day[0], 1.0, "u", "s", "x"),
            ("a", day[1], None, None, "s", "x"),  # the new null wins, the old null unit stays
            ("a", day[2], 30.0, "u", "s", "x"),
            ("a", day[3], 4.0, "n", "n", "n"),
        ],
        key=repr,
    )
    once = silver.upsert_value(target, batch)
    assert tuples(once) == want
    assert tuples(silver.upsert_value(once, batch)) == want


def test_layers(spark):
    layers = [silver.Layer("low", "LOW", "l"), silver.Layer("mid", "MID", "m"), silver.Layer("top", "TOP", "t")]
    schema = "indicator_code string, obs_date date, value double, pos long, series_id string"
    d1, d2, d3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    rows = spark.createDataFrame(
        [
            ("a", d1, 1.0, 9, "low"), ("a", d1, 2.0, 1, "top"), ("a", d1, 3.0, 0, "top"),
            ("a", d2, 4.0, 5, "low"), ("a", d2, 5.0, 6, "low"), ("a", d3, 6.0, 1, "low"),
            ("a", d3, None, 1, "top"), ("a", d3, 7.0, 1, "other"),
        ],
        schema,
    )
    collapsed = silver.collapse_layers(rows, layers)
    assert tuples(collapsed) == [
        ("a", d1, 2.0, "TOP", "t"), ("a", d2, 5.0, "LOW", "l"), ("a", d3, None, "TOP", "t"),
    ]
    target = spark.createDataFrame([("a", d2, 0.0, "u", "OLD", "o")], SILVER)
    assert tuples(silver.layered_upsert(target, collapsed)) == [
        ("a", d1, 2.0, None, "TOP", "t"), ("a", d2, 5.0, "u", "LOW", "l"), ("a", d3, None, None, "TOP", "t"),
    ]


def test_long_to_wide_leaves_missing_cells_null(spark):
    rows = obs(spark, [("a", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 2), 2.0), ("c", D(2024, 1, 3), 3.0)])
    wide = silver.long_to_wide(rows, {"a": "x", "b": "y"})
    assert tuples(wide) == [(D(2024, 1, 1), 1.0, None), (D(2024, 1, 2), None, 2.0)]


# --- monthly ------------------------------------------------------------------------------


def test_period_last_and_change_over_a_gap(spark):
    rows = obs(
        spark, [("a", D(2024, 1, 5), 10.0), ("a", D(2024, 1, 31), 20.0), ("a", D(2024, 3, 1), 30.0), ("a", D(2024, 3, 2), None)]
    )
    last = monthly.period_last(rows)
    assert tuples(last) == [("a", D(2024, 1, 1), 20.0), ("a", D(2024, 3, 1), None)]
    complete = monthly.period_last(rows.dropna())
    change = {r["obs_month"]: r["m"] for r in monthly.mom_pct(complete, "value", "m").collect()}
    assert change == {D(2024, 1, 1): None, D(2024, 3, 1): 50.0}


def test_change_from_zero_is_an_error(spark):
    rows = obs(spark, [("a", D(2024, 1, 1), 0.0), ("a", D(2024, 2, 1), 1.0)])
    with pytest.raises(ArithmeticException, match="DIVIDE_BY_ZERO"):
        monthly.mom_pct(monthly.period_last(rows), "value", "m").collect()


def test_set_monthly_left_join_semantics(spark):
    rows = obs(
        spark,
        [
            ("TH.SET_INDEX", D(2024, 1, 2), 100.0), ("TH.SET_INDEX", D(2024, 2, 2), 110.0),
            ("TH.SET_VOLUME", D(2024, 1, 2), 5.0), ("TH.SET_VOLUME", D(2024, 1, 3), 6.0),
            ("TH.SET_VOLUME", D(2024, 3, 1), 7.0),
        ],
    )
    got = tuples(monthly.set_monthly(rows))
    assert got[0] == (D(2024, 1, 1), 100.0, 11.0, None)
    assert got[1][:3] == (D(2024, 2, 1), 110.0, None) and got[1][3] == pytest.approx(10.0)
    assert len(got) == 2


def asof_by_inequality(rows, as_of, keys):
    """The textbook form: every month with every earlier observation. Only for small frames."""
    spine = monthly.month_spine(rows, as_of, keys)
    o = rows.select(*[F.col(k).alias(f"o_{k}") for k in keys], "obs_date", "value")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"o_{k}"))
    joined = spine.join(o, same & (F.col("obs_date") <= F.last_day("obs_month")))
    return joined.groupBy(*keys, "obs_month").agg(F.max_by("value", "obs_date").alias("value"))


def test_asof_equals_the_inequality_join(spark):
    random.seed(7)
    rows = {}
    for code in ("a", "b", "c", "d"):
        for _ in range(random.randint(1, 12)):
            day = D(2020, 1, 1) + dt.timedelta(random.randrange(1500))
            rows[code, day] = random.choice([None, round(random.random(), 3)])
    rows["late", D(2025, 1, 1)] = 1.0
    frame = obs(spark, [(*k, v) for k, v in rows.items()])
    for as_of in ("2022-06-15", "2024-12-31"):
        got = monthly.asof_month_end(frame, as_of)
        want = asof_by_inequality(frame, as_of, ["indicator_code"])
        assert tuples(got.select("indicator_code", "obs_month", "value")) == tuples(
            want.select("indicator_code", "obs_month", "value")
        )
        assert got.filter("indicator_code = 'late'").count() == 0


def test_asof_counts_the_whole_last_month(spark):
    rows = obs(spark, [("a", D(2024, 1, 31), 1.0), ("a", D(2024, 2, 20), 2.0), ("a", D(2024, 3, 1), 3.0)])
    assert [r["value"] for r in monthly.asof_month_end(rows, "2024-02-10").orderBy("obs_month").collect()] == [1.0, 2.0]
    assert monthly.asof_month_end(rows.limit(0), "2024-02-10").count() == 0
    assert monthly.month_spine(rows.limit(0), "2024-02-10").count() == 0


# --- views --------------------------------------------------------------------------------


def random_silver(spark):
    random.seed(3)
    codes = ["TH.SET_INDEX", "TH.SET_VOLUME", "FX.USDTHB", "TH.POLICY_RATE", "TH.CPI_YOY", "TH.BOND_10Y"]
    rows = {}
    for i, code in enumerate(codes):
        for _ in range(60):
            day = D(2018 + i % 3, 1, 1) + dt.timedelta(random.randrange(1200))
            rows[code, day] = round(1 + random.random() * 10, 2)
    rows["TH.SET_VOLUME", D(2030, 1, 1)] = 1.0  # a month with nothing but volume
    rows["TH.CPI_YOY", D(2019, 1, 1)] = 0.0  # a zero where no change is reported
    rows["OTHER", D(2019, 1, 1)] = 1.0
    return obs(spark, [(*k, v) for k, v in rows.items()])


def test_single_pass_dashboard_equals_the_join_of_the_marts(spark):
    rows, as_of = random_silver(spark), "2024-05-05"
    marts = [
        monthly.set_monthly(rows, scale=2),
        monthly.fx_monthly(rows),
        monthly.policy_rate_monthly(rows, as_of),
        monthly.cpi_monthly(rows, scale=2),
        monthly.bond_monthly(rows, scale=2),
    ]
    joined = marts[0]
    for mart in marts[1:]:
        joined = joined.join(mart, "obs_month", "full_outer")
    joined = joined.withColumn("real_rate", F.expr("policy_rate - cpi_yoy")).select(crossmart.DASHBOARD_COLUMNS)
    want = tuples(joined)
    assert tuples(crossmart.dashboard_monthly(*marts)) == want
    assert tuples(crossmart.dashboard_from_silver(rows, as_of, scale=2)) == want
    assert D(2030, 1, 1) not in {r[0] for r in want}


DASHBOARD = (
    "obs_month date, set_close double, set_mom double, set_volume double, usdthb double, usdthb_mom double, "
    "policy_rate double, cpi_yoy double, bond_10y double, real_rate double"
)


def months(n, start=2020):
    return [D(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def test_correlation_edges(spark):
    x = [1.0, 2.0, 3.0, 4.0]
    rows = [(m, None, v, None, None, 2 * v, 5.0, -v, None, None) for m, v in zip(months(4), x, strict=True)]
    rows.append((D(2021, 1, 1), None, 9.0, None, None, None, 1.0, 1.0, 2.0, None))
    matrix = crossmart.correlation_matrix(spark.createDataFrame(rows, DASHBOARD))
    got = {(r["var1"], r["var2"]): (r["correlation"], r["n"]) for r in matrix.collect()}
    assert got["set_mom", "usdthb_mom"] == (1.0, 4)
    assert got["set_mom", "cpi_yoy"] == (-1.0, 4)
    assert got["set_mom", "policy_rate"] == (None, 4)  # constant over the complete months
    assert got["bond_10y", "policy_rate"] == (None, 1)
    assert got["bond_10y", "usdthb_mom"] == (None, 0)
    split = crossmart.corr_complete_case(spark.createDataFrame(rows, DASHBOARD)).unionByName(
        crossmart.corr_pairwise(spark.createDataFrame(rows, DASHBOARD))
    )
    assert tuples(split) == tuples(matrix)


def test_correlation_of_nothing(spark):
    matrix = crossmart.correlation_matrix(spark.createDataFrame([], DASHBOARD))
    assert {(r["correlation"], r["n"]) for r in matrix.collect()} == {(None, 0)} and matrix.count() == 9


def test_ranking_puts_nulls_first(spark):
    matrix = spark.createDataFrame(
        [("a", "b", 0.1, 3), ("a", "c", None, 0), ("a", "d", -0.9, 3), ("a", "a", 0.9, 3)],
        "var1 string, var2 string, correlation double, n long",
    )
    assert [r["var2"] for r in crossmart.corr_ranked(matrix).collect()] == ["c", "a", "d", "b"]


# --- forecasts ----------------------------------------------------------------------------


def test_perfect_season_is_continued(spark):
    shape = [float(i * i % 7) for i in range(12)]
    rows = [("s", m, 100.0 + 2.0 * i + shape[i % 12]) for i, m in enumerate(months(48))]
    actuals = spark.createDataFrame(rows, "indicator string, obs_month date, value double")
    fits = forecast.hw_fit(actuals)
    ahead = forecast.hw_band(fits).orderBy("obs_month").collect()
    assert [r["obs_month"] for r in ahead] == [D(2024, i, 1) for i in range(1, 7)]
    want = [100.0 + 2.0 * i + shape[i % 12] for i in range(48, 54)]
    assert np.allclose([r["yhat"] for r in ahead], want, atol=0.01)
    assert all(r["yhat_lower"] == r["yhat"] == r["yhat_upper"] for r in ahead)


def test_fit_does_not_depend_on_batch_or_neighbours(spark):
    random.seed(11)
    rows = [
        (f"s{k}", m, random.random() * 100) for k, n in enumerate((24, 25, 40, 24, 61, 23)) for m in months(n)
    ]
    actuals = spark.createDataFrame(rows, "indicator string, obs_month date, value double")
    together = {r["indicator"]: tuple(r) for r in forecast.hw_fit(actuals).collect()}
    assert sorted(together) == ["s0", "s1", "s2", "s3", "s4"]
    alone = forecast.hw_fit(actuals.filter("indicator = 's4'")).first()
    assert tuple(alone) == together["s4"]
    assert [tuple(r) for r in forecast.short_series(actuals).collect()] == [("s5", 23)]
    with pytest.raises(ValueError, match="s5"):
        forecast.require_two_seasons(actuals)


def test_fit_by_plain_recursion(spark):
    random.seed(5)
    y = [50 + 10 * random.random() + i for i in range(37)]
    rows = [("s", m, v) for m, v in zip(months(37), y, strict=True)]
    got = forecast.hw_fit(spark.createDataFrame(rows, "indicator string, obs_month date, value double")).first()

    def run(a, b, c):
        centred = {t: (y[t - 6] / 2 + sum(y[t - 5 : t + 6]) + y[t + 6] / 2) / 12 for t in range(6, 30)}
        raw = [np.mean([y[t] - centred[t] for t in range(p, 36, 12) if t in centred]) for p in range(12)]
        season, errors = [r - np.mean(raw) for r in raw], []
        trend, at_zero = np.polyfit(range(6, 18), [centred[t] for t in range(6, 18)], 1)
        level = at_zero - trend
        for t, v in enumerate(y):
            base, s = level + trend, season[t % 12]
            errors.append(v - base - s)
            new = a * (v - s) + (1 - a) * base
            trend = b * (new - level) + (1 - b) * trend
            level, season[t % 12] = new, c * (v - base) + (1 - c) * s
        return sum(e * e for e in errors), a, b, c, np.std(errors, ddof=1)

    grid = forecast.GRID
    sse, a, b, c, sigma = min(run(a, b, c) for a in grid for b in grid for c in grid)
    assert (got["alpha"], got["beta"], got["gamma"]) == (a, b, c)
    assert got["sse"] == pytest.approx(sse) and got["sigma"] == pytest.approx(sigma)


# --- serving ------------------------------------------------------------------------------


def board(spark, values):
    return spark.createDataFrame(
        [(m, v) for m, v in values], "obs_month date, set_close double"
    )


def test_trim_null_edges(spark):
    rows = board(spark, list(zip(months(6), [None, 1.0, None, 2.0, None, None], strict=True)))
    assert [r["set_close"] for r in serving.trim_null_edges(rows, "set_close").orderBy("obs_month").collect()] == [1, None, 2]
    assert serving.trim_null_edges(board(spark, [(D(2020, 1, 1), None)]), "set_close").count() == 0


@pytest.mark.parametrize(
    "lo,hi,want",
    [
        ("2020-02-20", "2020-05-01", [1, 3, 5]),
        ("2020-03-20", "2020-04-30", [3]),
        ("2019-01-01", "2020-04-30", [1, 3]),
        ("2020-12-01", "2020-03-01", [3]),
        ("2019-01-01", "2019-02-01", [1]),
    ],
)
def test_month_range_snaps(spark, lo, hi, want):
    rows = board(spark, [(D(2020, m, 1), 1.0) for m in (1, 3, 5)])
    assert sorted(r["obs_month"].month for r in serving.month_range(rows, lo, hi).collect()) == want


def test_extreme_month_prefers_the_earliest(spark):
    values = [(D(2020, 1, 1), 5.0), (D(2020, 2, 1), 9.0), (D(2020, 3, 1), 9.0), (D(2020, 4, 1), None), (D(2021, 1, 1), 1.0)]
    rows = board(spark, values)
    assert tuples(serving.extreme_month(rows, "set_close")) == [(2020, D(2020, 2, 1), 9.0), (2021, D(2021, 1, 1), 1.0)]
    assert tuples(serving.extreme_month(rows, "set_close", 2020, highest=False)) == [(2020, D(2020, 1, 1), 5.0)]


def test_latest_stats_reads_value_and_change_from_the_same_row(spark):
    none = (None,) * 9
    rows = [(D(2024, 1, 1), 10.0, 1.5, 1.0, 33.0, -0.5, 2.0, None, None, None), (D(2024, 2, 1), None, 7.0, *none[2:]),
            (D(2024, 3, 1), None, None, None, None, 9.0, 2.5, None, None, None)]
    got = {r["metric"]: tuple(r)[1:] for r in serving.latest_stats(spark.createDataFrame(rows, DASHBOARD)).collect()}
    assert got == {
        "set_close": (D(2024, 1, 1), 10.0, 1.5, "up"),
        "usdthb": (D(2024, 1, 1), 33.0, -0.5, "down"),
        "policy_rate": (D(2024, 3, 1), 2.5, None, None),
        "cpi_yoy": (None, None, None, None),
    }


FORECAST = "indicator string, obs_month date, yhat double, yhat_lower double, yhat_upper double, is_forecast boolean"


def forecast_rows(spark, actual, ahead):
    m = months(actual + ahead)
    return spark.createDataFrame(
        [("a", m[i], float(i), None, None, False) for i in range(actual)]
        + [("a", m[i], float(i), i - 1.0, i + 1.0, True) for i in range(actual, actual + ahead)],
        FORECAST,
    )


@pytest.mark.parametrize("actual,ahead,want", [(30, 6, 18), (5, 6, 11), (20, 0, 20), (0, 6, 6)])
def test_forecast_window(spark, actual, ahead, want):
    got = serving.forecast_window(forecast_rows(spark, actual, ahead))
    assert got.count() == want and got.columns == forecast_rows(spark, 1, 0).columns


def test_plot_series_meet_at_the_last_actual(spark):
    got = [tuple(r)[2:] for r in serving.forecast_plot_series(forecast_rows(spark, 2, 1)).orderBy("obs_month").collect()]
    assert got == [(0.0, None, None, None), (1.0, 1.0, 1.0, 1.0), (None, 2.0, 3.0, 1.0)]


def test_preview_counts_all_rows(spark):
    got = serving.preview_with_total(spark.range(100), ["id"]).collect()
    assert [tuple(r) for r in got] == [(i, 100) for i in range(12)]


# --- text ---------------------------------------------------------------------------------

STATEMENTS = [
    ("SELECT 1", True),
    ("   　with x as (select 1) select * from x ;;;\n", True),
    ("select 1; select 2", False),
    ("select 1; ;", False),
    ("selection from t", False),
    ("select_all", False),
    ("select", True),
    ("select 'update' from t", False),
    ("select updated_at, recall from t", True),
    ("select drop_date from t", True),
    ("select กdrop from t", True),
    ("select 1 -- DROP", False),
    ("explain select 1", False),
    ("\x1fselect 1", True),
    ("ſelect 1", True),  # the long s folds to s
    ("", False),
]


def applied(spark, function, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string").withColumn("r", function("s"))
    return [r["r"] for r in rows.orderBy("i").collect()]


def test_screening(spark):
    got = applied(spark, text.is_safe_select, [s for s, _ in STATEMENTS])
    assert list(zip([s for s, _ in STATEMENTS], got, strict=True)) == STATEMENTS


def test_fences(spark):
    cases = [
        ("```sql\nselect 1\n```", "select 1"),
        (" ```SQL   select 1```  ", "select 1"),
        ("select '```sql' from t", "select '```sql' from t"),
        ("```sql\n```sql\nx", "x"),
        ("a\n```sql \nb\n```\nc", "a\nb\n\nc"),
        ("```sql```", ""),
        ("a\u2028```sql b", "a\u2028```sql b"),  # only a line feed ends a line
        ("\u3000no fence\x1f", "no fence"),
    ]
    assert applied(spark, text.strip_code_fence, [raw for raw, _ in cases]) == [clean for _, clean in cases]


def test_reply(spark):
    assert applied(spark, text.clean_reply_text, [" a — b—c\n"]) == ["a , b,c"]
