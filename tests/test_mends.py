"""Failures must not lose data: failed mart loads, absent forecast series, long failure reports."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrolake.operators import forecast
from macrolake.operators import quality as q
from macrolake.sources import lake


def test_failed_load_leaves_the_mart(spark, tmp_path):
    path = str(tmp_path / "mart")
    schema = T.StructType([T.StructField("x", T.LongType())])
    lake.sink_truncate_load(spark.range(2).select(F.col("id").alias("x")), path, schema)
    with pytest.raises(Exception):
        lake.sink_truncate_load(spark.range(4).select(F.expr("10 div (id - 3)").alias("x")), path, schema)
    assert spark.read.parquet(path).count() == 2
    assert os.listdir(tmp_path) == ["mart"]


def test_absent_series_raises(spark):
    actuals = spark.createDataFrame([("a", i, 1.0) for i in range(24)], "indicator string, obs_month int, value double")
    forecast.require_two_seasons(actuals, expected=["a"])
    with pytest.raises(ValueError, match="in 1 series.*b \\(0\\)"):
        forecast.require_two_seasons(actuals, expected=["a", "b"])


def test_all_failures_are_written(spark):
    report = spark.range(250).selectExpr(
        "'s' AS suite", "concat('r', id) AS rule", "CAST(NULL AS STRING) AS column_name", "1L AS n_rows", "1L AS n_failed", "false AS passed"
    )
    with pytest.raises(q.DataQualityError) as error:
        q.dq_enforce(report, shown=10)
    assert error.value.total == 250 and len(error.value.failures) == 10
    assert spark.read.parquet(error.value.path).count() == 250


def test_fit_needs_no_package_on_the_executors():
    code = """
        import cloudpickle, sys
        from macrolake.operators import forecast
        sys.stdout.buffer.write(cloudpickle.dumps(forecast._grid_search(12, (0.0, 0.5))))
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cloud = "from pyspark import cloudpickle"
    made = subprocess.run([sys.executable, "-c", textwrap.dedent(code).replace("import cloudpickle, sys", f"import sys; {cloud}")], cwd=root, capture_output=True, check=True)
    used = "import sys, pickle, pandas as pd; f = pickle.loads(sys.stdin.buffer.read()); print(len(f(pd.Series([[float(i % 12) for i in range(36)]]))))"
    ran = subprocess.run([sys.executable, "-c", used], cwd="/", input=made.stdout, capture_output=True, check=True)
    assert ran.stdout.strip() == b"1"


def test_appends_at_the_same_time_keep_every_row(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path, sizes = str(tmp_path / "bronze"), [40_000, 10, 5_000, 1, 20_000]

    def land(i):
        rows = spark.range(sizes[i]).selectExpr(f"'s{i % 2}' AS series_id", "id AS part", "'{}' AS payload", "'{}' AS request_params")
        lake.append_batch(rows, path, f"b{i}", "X")

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(land, range(5)))
    stored = spark.read.parquet(path).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in stored} == {f"b{i}": n for i, n in enumerate(sizes)}


def test_latest_batch_reads_the_newest_folders_only(spark, tmp_path):
    from macrolake.operators import bronze

    path = str(tmp_path / "bronze")
    for batch, day in (("b", 1), ("a", 2)):  # the later batch has the smaller id
        rows = spark.range(3).selectExpr("'s' AS series_id", "id AS part", f"'{batch}' AS payload", "'{}' AS request_params")
        lake.append_batch(rows, path, batch, "X", F.to_timestamp(F.lit(f"2024-01-0{day}")))
    newest = bronze.latest_batch(spark.read.parquet(path).filter(F.col("series_id").isin(["s"])))
    assert {r["payload"] for r in newest.collect()} == {"a"}
    assert "dynamicpruning" in newest._jdf.queryExecution().toString().lower()


def test_listed_keys_without_rows_end_up_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, x int")
    lake.replace_by_key(rows, path, "k")
    lake.replace_by_key(rows.filter("k = 'a'").withColumn("x", F.lit(9)), path, "k", ["a", "b"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "x").collect()) == [("a", 9), ("c", 3)]


def test_documents_as_delivered(spark, tmp_path):
    import json

    from macrolake.sources import landed

    statistics = {"result": {"series": [{"series_code": "A", "observations": [{"period_start": "2024-01", "value": "2.5"}, {"period_start": "2024-02", "value": None}]}, {"observations": []}]}}
    (tmp_path / "s.json").write_text(json.dumps(statistics, indent=1))
    rows = landed.normalize_monthly_series(landed.read_statistics_document(spark, str(tmp_path / "s.json"))).collect()
    assert [(str(r.obs_date), r.value) for r in rows] == [("2024-01-01", 2.5)]
    record = {"effective_datetime": "2024-11-13 14:00:00", "data": "2.25", "news_text_en": "hold", "extra": {"n": 1}}
    (tmp_path / "e.json").write_text(json.dumps({"result": record}, indent=1))
    row = landed.normalize_event_snapshot(landed.read_snapshot_document(spark, str(tmp_path / "e.json"))).first()
    assert (str(row.obs_date), row.value, row.news_th, row.news_en) == ("2024-11-13", 2.25, None, "hold")
    assert json.loads(row.raw) == record
