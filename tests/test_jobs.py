"""The batch jobs from landed files to the gold views."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from macrolake import schemas
from macrolake.operators.quality import DataQualityError
from macrolake.operators.serving import UnsafeStatement
from macrolake.plans import jobs
from macrolake.sources import landed

AS_OF = dt.date(2024, 12, 31)


def days(spark, first, last, value):
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("obs_date")
    ).withColumn("value", value)


def months(spark, first, last, value):
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("obs_date")
    ).withColumn("value", value)


def quotes_file(spark, path, last="2024-12-31", bump=0.0):
    wave = 1500.0 + F.dayofyear("obs_date") * 0.5 + F.month("obs_date") * 3.0 + bump
    rows = days(spark, "2021-01-01", last, wave).select(
        F.col("obs_date").alias("Date"),
        F.col("value").alias("Close"),
        # Closed on the last two days of each week.
        F.when(F.dayofweek("obs_date").isin(1, 7), 0.0).otherwise(1e6).alias("Volume"),
    )
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return landed.normalize_ohlc(landed.read_landed(spark, path, schemas.QUOTES, "csv"))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = jobs.Lake(spark, str(root / "lake"))
    jobs.ingest_set(lake, quotes_file(spark, str(root / "quotes")), AS_OF)
    rates = days(spark, "2022-01-01", "2024-12-27", 33.0 + F.month("obs_date") / 10.0)
    jobs.ingest_fx(lake, landed.drop_missing_value(rates), AS_OF)
    snapshot = spark.createDataFrame(
        [("2024-11-13 14:00:00", "2.25", None, "hold")], schemas.POLICY_SNAPSHOT
    )
    backfill = months(spark, "2015-01-01", "2024-06-01", F.lit(1.5))
    statistics = months(spark, "2024-05-01", "2024-10-01", F.lit(2.5))
    jobs.ingest_policy_rate(lake, landed.normalize_event_snapshot(snapshot), AS_OF, backfill, statistics)
    jobs.ingest_inflation(lake, months(spark, "2015-01-01", "2024-03-01", F.lit(1.2)))
    jobs.ingest_bond(lake, months(spark, "2023-01-01", "2024-11-01", F.month("obs_date") / 4.0))
    jobs.refresh_forecasts(lake)
    return lake


def by_month(df, *columns):
    return {str(r["obs_month"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_set_mart(lake):
    mart = by_month(lake.mart("set_monthly"), "set_close", "set_volume", "set_mom")
    assert len(mart) == 48
    assert mart["2021-01-01"][2] is None
    # 2021-01-29 is the last traded day of January (21 days traded).
    assert mart["2021-01-01"][:2] == (1500.0 + 29 * 0.5 + 3.0, 21e6)


def test_policy_rate_layers_and_carry(lake):
    mart = by_month(lake.mart("policy_rate_monthly"), "policy_rate")
    assert min(mart) == "2015-01-01" and max(mart) == "2024-12-01" and len(mart) == 120
    assert mart["2024-04-01"] == (1.5,)
    assert mart["2024-05-01"] == (2.5,)  # statistics win over the backfill
    assert mart["2024-11-01"] == (2.25,)  # the decision day
    assert mart["2024-12-01"] == (2.25,)  # carried forward
    sources = {r["source"] for r in lake.observations().filter("indicator_code = 'TH.POLICY_RATE'").collect()}
    assert sources == {"BIS", "BOT_STAT", "BOT"}


def test_dashboard_joins_all_marts(lake):
    views = jobs.gold_views(lake)
    rows = by_month(views["dashboard_monthly"], "set_close", "usdthb", "policy_rate", "cpi_yoy", "real_rate")
    assert len(rows) == 120
    assert rows["2015-01-01"][0] is None and rows["2015-01-01"][4] == pytest.approx(0.3)
    assert rows["2024-12-01"][3] is None and rows["2024-12-01"][4] is None
    assert views["correlation_matrix"].count() == 9
    assert views["real_rate_monthly"].count() == 111


def test_dims_have_all_indicators(lake):
    assert {r["indicator_code"] for r in lake.dims().collect()} == {
        "TH.SET_INDEX", "TH.SET_VOLUME", "FX.USDTHB", "TH.POLICY_RATE", "TH.CPI_YOY", "TH.BOND_10Y",
    }


def test_rerun_changes_nothing_but_values(spark, lake, tmp_path):
    before = {tuple(r) for r in lake.observations().collect()}
    quotes = quotes_file(spark, str(tmp_path / "again"))
    jobs.ingest_set(lake, quotes, AS_OF)
    assert {tuple(r) for r in lake.observations().collect()} == before
    changed = quotes_file(spark, str(tmp_path / "changed"), bump=1.0)
    jobs.ingest_set(lake, changed, AS_OF)
    after = {tuple(r) for r in lake.observations().collect()}
    key = lambda rows: {r[:2] + r[3:] for r in rows}  # noqa: E731  (all but the value)
    assert key(after) == key(before) and after != before
    assert len(lake.raw().select("batch_id").filter("series_id = '^SET.BK'").distinct().collect()) == 3
    jobs.ingest_set(lake, quotes, AS_OF)


def test_failed_gate_keeps_the_mart(spark, lake, tmp_path):
    before = by_month(lake.mart("set_monthly"), "set_close")
    with pytest.raises(DataQualityError, match="fresh"):
        jobs.ingest_set(lake, quotes_file(spark, str(tmp_path / "q")), dt.date(2025, 3, 1))
    assert by_month(lake.mart("set_monthly"), "set_close") == before


def test_forecast_refresh_touches_one_indicator(lake):
    rows = lake.forecasts().collect()
    ahead = [r for r in rows if r["is_forecast"]]
    assert sorted({r["indicator"] for r in rows}) == ["FX.USDTHB", "TH.SET_INDEX"]
    assert len(ahead) == 12 and {r["model"] for r in ahead} == {"holt-winters"}
    assert min(r["obs_month"] for r in ahead) == dt.date(2025, 1, 1)
    stamps = {r["indicator"]: r["generated_at"] for r in rows}
    jobs.refresh_forecasts(lake, "FX.USDTHB")
    again = {r["indicator"]: r["generated_at"] for r in lake.forecasts().collect()}
    assert again["TH.SET_INDEX"] == stamps["TH.SET_INDEX"] and again["FX.USDTHB"] > stamps["FX.USDTHB"]
    assert lake.forecasts().count() == len(rows)


def test_ask(lake):
    answer = jobs.ask(
        lake,
        "SELECT obs_month, policy_rate FROM gold.dashboard_monthly WHERE policy_rate IS NOT NULL "
        "ORDER BY obs_month DESC LIMIT 1;",
    )
    assert [tuple(r) for r in answer.collect()] == [(dt.date(2024, 12, 1), 2.25)]
    literal = jobs.ask(lake, "select 'gold.dashboard_monthly' as name, count(*) as n from gold.correlation_matrix")
    assert tuple(literal.first()) == ("gold.dashboard_monthly", 9)


@pytest.mark.parametrize(
    "statement",
    [
        "delete from gold.dashboard_monthly",
        "select 1; select 2",
        "select reflect('java.lang.System', 'getenv')",
        "select `reflect`('java.lang.Math', 'max', 1, 2)",
        "select reflect/**/('java.lang.Math', 'max', 1, 2)",
    ],
)
def test_ask_rejects(lake, statement):
    with pytest.raises(UnsafeStatement):
        jobs.ask(lake, statement)


def test_ask_sees_gold_only(spark, lake):
    with pytest.raises(Exception, match="(?i)not.?found|unsupported"):
        jobs.ask(lake, f"select * from parquet.`{lake.observation_path}`")
    lake.observations().createOrReplaceTempView("macro_observation")
    with pytest.raises(UnsafeStatement):
        jobs.ask(lake, "select * from macro_observation")


def test_missing_optional_inflation(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(DataQualityError, match="min_rows"):
        jobs.ingest_inflation(lake, None)


def test_policy_rate_with_a_broken_layer(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    snapshot = spark.createDataFrame([("2024-11-13 14:00:00", "2.25", None, None)], schemas.POLICY_SNAPSHOT)
    broken = days(spark, "2024-01-01", "2024-01-03", F.raise_error(F.lit("malformed")).cast("double"))
    statistics = months(spark, "2015-01-01", "2024-10-01", F.lit(2.5))
    jobs.ingest_policy_rate(lake, landed.normalize_event_snapshot(snapshot), AS_OF, broken, statistics)
    assert lake.mart("policy_rate_monthly").count() == 120


def test_policy_rate_without_history(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    snapshot = spark.createDataFrame([("2024-11-13 14:00:00", "2.25", None, None)], schemas.POLICY_SNAPSHOT)
    with pytest.raises(DataQualityError, match="min_rows"):
        jobs.ingest_policy_rate(lake, landed.normalize_event_snapshot(snapshot), AS_OF)
    assert lake.observations().count() == 1
