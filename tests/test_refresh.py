"""Publication, merges by year, exact sums, delivery order, replays and incremental refresh."""

import datetime as dt
import glob
import math
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrolake.operators import crossmart, monthly, refresh, silver
from macrolake.plans import jobs
from macrolake.sources import lake, landed
from macrolake.sources.merge import BY_YEAR, merge_by_year, with_year

_X = T.StructType([T.StructField("x", T.LongType())])


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("x"))


# --- publication -----------------------------------------------------------------------------


@pytest.mark.parametrize("step,rows", [(1, 2), (2, 2), (3, 4)])
def test_a_failure_at_any_step_leaves_a_readable_mart(spark, tmp_path, monkeypatch, step, rows):
    path = str(tmp_path / "mart")
    lake.sink_truncate_load(numbers(spark, 2), path, _X)
    rename, remove, calls = lake._rename, lake.remove, []

    def failing_rename(session, source, target):
        calls.append((source, target))
        if len(calls) == step:
            raise OSError("lost")
        rename(session, source, target)

    def failing_remove(session, folder):
        if step == 3 and "__old-" in folder:
            raise OSError("lost")
        remove(session, folder)

    with monkeypatch.context() as m:
        m.setattr(lake, "_rename", failing_rename)
        m.setattr(lake, "remove", failing_remove)
        if step == 3:
            lake.sink_truncate_load(numbers(spark, 4), path, _X)
        else:
            with pytest.raises(OSError, match="lost"):
                lake.sink_truncate_load(numbers(spark, 4), path, _X)
    assert spark.read.parquet(path).count() == rows
    assert len(os.listdir(tmp_path)) == (2 if step == 3 else 1)  # the old rows may be left aside
    lake.sink_truncate_load(numbers(spark, 5), path, _X)  # the next load clears them
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["mart"]


def test_a_lost_driver_is_recovered_from(spark, tmp_path):
    path = str(tmp_path / "mart")
    lake.sink_truncate_load(numbers(spark, 3), path, _X)
    lake._rename(spark, path, lake._beside(path, "old"))  # and then the driver is gone
    lake.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["mart"]


def test_a_load_may_read_its_own_mart(spark, tmp_path):
    path = str(tmp_path / "mart")
    lake.sink_truncate_load(numbers(spark, 3), path, _X)
    lake.sink_overwrite_self(spark.read.schema(_X).parquet(path).filter("x > 0"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2]


# --- merges by year ----------------------------------------------------------------------------


def observations(spark, rows):
    frame = spark.createDataFrame([(c, dt.date.fromisoformat(d), v) for c, d, v in rows], "indicator_code string, obs_date date, value double")
    return frame.withColumn("unit", F.lit("u"))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(c, f"{y}-{m:02d}-01", float(y + m)) for c in ("A", "B") for y in range(2015, 2021) for m in (1, 6)]
    lake.replace_partitions(with_year(observations(spark, rows)), path, *BY_YEAR)
    return path


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*/*.parquet")}


def reading(spark, path):
    return lambda: lake.scan_parquet(spark, path, "indicator_code string, obs_date date, value double, unit string, obs_year int")


def test_a_late_value_rewrites_its_year_only(spark, table):
    before = files(table)
    batch = observations(spark, [("A", "2016-06-01", -1.0), ("A", "2021-01-01", 5.0), ("A", "2018-01-01", 2019.0)])
    changed = merge_by_year(reading(spark, table), table, batch, silver.VALUE_ONLY)
    assert sorted((str(r.obs_date), r.value) for r in changed.collect()) == [("2016-06-01", -1.0), ("2021-01-01", 5.0)]
    after = files(table)
    new = {os.path.dirname(f).removeprefix(table + "/") for f in set(after) - set(before)}
    assert new == {"indicator_code=A/obs_year=2016", "indicator_code=A/obs_year=2021"}
    assert all(after[f] == before[f] for f in before if "A/obs_year=2016" not in f)
    values = {(r.indicator_code, str(r.obs_date)): r.value for r in spark.read.parquet(table).collect()}
    assert len(values) == 25 and values["A", "2016-06-01"] == -1.0 and values["A", "2016-01-01"] == 2017.0


def test_a_batch_without_news_writes_nothing(spark, table):
    before = files(table)
    called = []
    same = reading(spark, table)().drop("obs_year")
    assert merge_by_year(reading(spark, table), table, same, silver.VALUE_ONLY, called.append).isEmpty()
    assert files(table) == before and called == []


def test_nulls_count_as_values(spark, table):
    for value, n in ((None, 1), (None, 0), (7.0, 1), (float("nan"), 1), (float("nan"), 0)):
        batch = observations(spark, [("B", "2017-01-01", 0.0)]).withColumn("value", F.lit(value).cast("double"))
        assert merge_by_year(reading(spark, table), table, batch, silver.VALUE_ONLY).count() == n


def test_the_scan_is_filtered_by_partition(spark, table):
    touched = lake.partitions_of(with_year(observations(spark, [("A", "2016-06-01", 1.0), ("B", "2019-01-01", 1.0)])), *BY_YEAR)
    found = lake.in_partitions(reading(spark, table)(), touched)
    assert found.count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and "obs_year" in filters[0].split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert len({os.path.dirname(f) for f in found.inputFiles()}) <= 12
    assert lake.in_partitions(reading(spark, table)(), []).count() == 0


# --- exact sums --------------------------------------------------------------------------------


def exact(values):
    """The double nearest to the exact sum."""
    present = [v for v in values if v is not None]
    if not present:
        return None
    if not all(map(math.isfinite, present)):
        return sum(v for v in present if not math.isfinite(v))
    total = sum(map(Fraction, present))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def test_sums_are_exact_in_any_order(spark):
    draw = random.Random(4)
    kinds = [
        lambda: draw.uniform(-1, 1) * 10.0 ** draw.randint(-300, 300),
        lambda: draw.gauss(0, 1),
        lambda: draw.choice([1e16, 1.0, -1e16, 0.1, 0.0]),
        lambda: draw.choice([5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, -3e-320]),
        lambda: draw.choice([1, -1]) * 2.0 ** draw.randrange(-1074, 1023),
        lambda: draw.choice([1.7976931348623157e308, -1.7976931348623157e308, 1.0]),
        lambda: draw.choice([1.0, math.inf, None]),
        lambda: draw.choice([1.0, math.nan, None]),
        lambda: None,
    ]
    rows, want = [], {}
    for g in range(270):
        values = [kinds[g % 9]() for _ in range(draw.choice([1, 2, 3, 40, 200]))]
        want[f"s{g}"] = exact(values)
        rows += [(f"s{g}", dt.date(2020, 1, 1 + i % 31), v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "indicator_code string, obs_date date, value double")
    for partitions in (1, 7, 64):
        got = {r.indicator_code: r["sum"] for r in monthly.monthly_facts(frame.repartition(partitions)).collect()}
        assert {k for k in want if repr(got[k]) != repr(want[k]) and not got[k] == want[k] == 0} == set()
    means = monthly.period_avg(frame).filter("indicator_code = 's2'").first()
    assert means.value == want["s2"] / sum(r[0] == "s2" for r in rows)


def test_marts_do_not_depend_on_the_order(spark):
    draw = random.Random(5)
    rows = [(c, dt.date(2020, 1 + i % 3, 1 + i % 28), draw.gauss(0, 1) * 10 ** draw.randint(-9, 9)) for i in range(3000) for c in ("TH.SET_INDEX", "TH.SET_VOLUME", "TH.CPI_YOY")]
    unique = {(c, d): (c, d, v) for c, d, v in rows}
    frame = spark.createDataFrame(list(unique.values()), "indicator_code string, obs_date date, value double")
    seen = set()
    for partitions in (1, 7, 64):
        some = frame.repartition(partitions)
        seen.add((tuple(sorted(monthly.set_monthly(some).select("obs_month", "set_volume").collect())), tuple(sorted(monthly.cpi_monthly(some).collect()))))
    assert len(seen) == 1
    board = crossmart.dashboard_from_silver(frame, "2020-03-31").select("obs_month", "set_volume", "cpi_yoy").collect()
    volumes, rates = next(iter(seen))
    assert sorted((r.obs_month, r.set_volume) for r in board) == sorted(map(tuple, volumes))
    assert sorted((r.obs_month, r.cpi_yoy) for r in board) == sorted(map(tuple, rates))


# --- incremental refresh -----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_refreshed_dashboard_equals_the_full_one(spark, seed):
    draw = random.Random(seed)
    codes = ["TH.SET_INDEX", "TH.SET_VOLUME", "FX.USDTHB", "TH.POLICY_RATE", "TH.CPI_YOY", "TH.BOND_10Y", "OTHER"]
    silver_rows: dict = {}
    facts = spark.createDataFrame([], "indicator_code string, obs_month date, last double, sum double, avg double")
    board, before = None, None
    for step in range(4):
        batch = {}
        for _ in range(draw.choice([0, 1, 4, 15]) if step else 12):
            day = dt.date(2020 + draw.randrange(3), draw.randint(1, 12), draw.randint(1, 28))
            batch[draw.choice(codes), day] = draw.choice([None, round(draw.uniform(1, 9), 2)])
        silver_rows |= batch
        as_of = dt.date(draw.choice([2020, 2021, 2022, 2023]), draw.randint(1, 12), draw.randint(1, 28))
        schema = "indicator_code string, obs_date date, value double"
        rows = spark.createDataFrame([(*k, v) for k, v in silver_rows.items()], schema)
        touched = refresh.touched_months(spark.createDataFrame([(*k, v) for k, v in batch.items()], schema))
        facts = spark.createDataFrame(refresh.refreshed_facts(facts, rows, touched).collect(), facts.schema)
        full = crossmart.dashboard_from_silver(rows, as_of)
        if board is None:
            board = full.limit(0)
        affected = refresh.affected_months(facts, touched, as_of, before)
        board = spark.createDataFrame(refresh.refreshed_dashboard(board, facts, affected, as_of).collect(), full.schema)
        assert sorted(map(str, board.collect())) == sorted(map(str, full.collect()))
        before = as_of


def quotes(spark, start, days, bump=0.0):
    first = dt.date.fromisoformat(start)
    rows = [(first + dt.timedelta(days=i), 1500.0 + i % 50 + bump, 1e9 + i) for i in range(days)]
    return spark.createDataFrame(rows, "obs_date date, close double, volume double")


def test_jobs_refresh_the_stored_dashboard(spark, tmp_path):
    store = jobs.Lake(spark, str(tmp_path))
    cpi = spark.createDataFrame([(dt.date(2015 + i // 12, i % 12 + 1, 1), float(i % 7)) for i in range(120)], "obs_date date, value double")
    jobs.ingest_set(store, quotes(spark, "2023-01-01", 400), "2024-02-05")
    jobs.ingest_inflation(store, cpi)
    jobs.refresh_dashboard(store, "2024-02-05")

    def same(as_of):
        full = crossmart.dashboard_from_silver(store.observations(), as_of)
        return sorted(map(str, store.dashboard().collect())) == sorted(map(str, full.select(store.dashboard().columns).collect()))

    assert same("2024-02-05") and store.pending().isEmpty()
    jobs.ingest_set(store, quotes(spark, "2024-01-20", 130, bump=3.0), "2024-05-28")
    notes = {(r.indicator_code, str(r.obs_month)) for r in store.pending().collect()}
    assert ("TH.SET_INDEX", "2024-05-01") in notes and ("TH.SET_INDEX", "2023-12-01") not in notes
    jobs.refresh_dashboard(store, "2024-05-28")
    assert same("2024-05-28") and store.pending().isEmpty()
    jobs.refresh_dashboard(store, "2024-05-28")
    assert same("2024-05-28")


# --- delivery order and replays ----------------------------------------------------------------


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_the_later_file_wins(spark, tmp_path, file_format):
    folder = tmp_path / "landed"
    old = spark.range(20_000).select(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("obs_date"), F.col("id").cast("double").alias("value"))
    new = old.limit(10).select("obs_date", F.lit(-1.0).alias("value"))
    for frame, at in ((new, 2_000_000_000), (old, 1_000_000_000)):
        part = str(tmp_path / f"part{at}")
        frame.coalesce(1).write.option("header", "true").format(file_format).save(part)
        os.makedirs(folder, exist_ok=True)
        name = glob.glob(f"{part}/part-*")[0]
        target = folder / ("z_old" if frame is old else "a_new")
        os.rename(name, f"{target}.{file_format}")
        os.utime(f"{target}.{file_format}", (at, at))
    schema = T.StructType([T.StructField("obs_date", T.DateType()), T.StructField("value", T.DoubleType())])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in ("4k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = landed.drop_missing_value(landed.in_delivery_order(landed.read_landed(spark, str(folder), schema, file_format)))
            last = silver.dedupe_last(rows.withColumn("indicator_code", F.lit("i")))
            got = {r.obs_date: r.value for r in last.collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        first = dt.date(1960, 1, 1)
        assert len(got) == 5000 and all(got[first + dt.timedelta(days=i)] == (-1.0 if i < 10 else 15_000.0 + i) for i in range(5000))


def test_stages_replay(spark, tmp_path):
    store = jobs.Lake(spark, str(tmp_path))
    runs = [jobs.new_run_id() for _ in range(2)]
    for run, bump in zip(runs, (0.0, 5.0)):
        jobs.ingest_set(store, quotes(spark, "2023-01-01", 400, bump), "2024-02-05", run_id=run)

    def state():
        return sorted(map(str, store.mart("set_monthly").collect())), store.raw().select("batch_id").distinct().count(), store.raw().count()

    after = state()
    assert after[1] == 2
    jobs.set_to_bronze(store, runs[1], quotes(spark, "2023-01-01", 400, 5.0))
    before = files(store.observation_path)
    jobs.set_to_silver(store, runs[1])
    assert files(store.observation_path) == before
    jobs.set_to_gold(store, "2024-02-05")
    assert state() == after
    jobs.set_to_silver(store, runs[0])  # an older run can be put back
    jobs.set_to_gold(store, "2024-02-05")
    assert state()[0] != after[0] and state()[1:] == after[1:]
    jobs.set_to_silver(store)  # without an id: the newest
    jobs.set_to_gold(store, "2024-02-05")
    assert state() == after
