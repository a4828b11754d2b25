"""Check queries: scans, sinks, source normalisation, bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from macrolake import schemas
from macrolake.operators import bronze, monthly, silver
from macrolake.plans import inputs
from macrolake.plans.inputs import obs_long, obs_raw, table
from macrolake.plans.registry import check
from macrolake.session import shared_dir
from macrolake.sources import lake, landed

_OBS = "indicator_code string, obs_date date, value double"


# --- scans and sinks ----------------------------------------------------------------------


@check(
    "scan_parquet",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
              o_orderpriority FROM orders""",
)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.scan_parquet(spark, f"{sf_dir}/orders.parquet").withColumn("o_orderdate", F.to_date("o_orderdate"))


@check("sink_overwrite", f"WITH {inputs.SET_DAILY} SELECT obs_date, close, volume FROM set_daily")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    daily = inputs.set_daily(spark, sf_dir).select("obs_date", "close", "volume")
    lake.sink_overwrite(daily.select("obs_date"), path)
    lake.sink_overwrite(daily, path)
    return lake.scan_parquet(spark, path)


@check("sink_partitioned", f"WITH {inputs.OBS_LONG} SELECT * FROM obs_long")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    lake.sink_partitioned(obs_long(spark, sf_dir), path, "indicator_code")
    return lake.scan_parquet(spark, path, _OBS)


@check("sink_truncate_load", f"WITH {inputs.MARTS} SELECT * FROM set_monthly")
def sink_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    mart = monthly.set_monthly(inputs.market_rows(spark, sf_dir), scale=inputs.SCALE)
    for _ in range(2):
        lake.sink_truncate_load(mart, path, schemas.SET_MONTHLY)
    return lake.scan_parquet(spark, path, schemas.SET_MONTHLY)


@check(
    "replace_by_key",
    f"""WITH {inputs.PRIORITY_PANEL}, {inputs.OBS_LONG}
    SELECT indicator, obs_month, value FROM panel WHERE indicator NOT IN ('1-URGENT', '5-LOW')
    UNION ALL
    SELECT indicator_code, CAST(date_trunc('month', obs_date) AS DATE), max(value) FROM obs_long
    WHERE indicator_code IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""",
)
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    lake.replace_by_key(inputs.priority_panel(spark, sf_dir), path, "indicator")
    refreshed = (
        silver.select_series(obs_long(spark, sf_dir), "1-URGENT", "5-LOW")
        .groupBy(F.col("indicator_code").alias("indicator"), F.trunc("obs_date", "month").alias("obs_month"))
        .agg(F.max("value").alias("value"))
    )
    lake.replace_by_key(refreshed, path, "indicator")
    return lake.scan_parquet(spark, path, "obs_month date, value double, indicator string")


_ORDER_DOCUMENTS = f"""{inputs.OBS_RAW},
order_documents AS (
  SELECT indicator_code AS series_id, pos // 10000 AS part,
         to_json({{'obs': list({{'obs_date': CAST(obs_date AS VARCHAR), 'value': value}} ORDER BY pos)}}) AS payload,
         to_json({{'code': indicator_code}}) AS request_params
  FROM obs_raw GROUP BY ALL
)"""


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.pack_payload(obs_raw(spark, sf_dir), "indicator_code", ["obs_date", "value"])


_RANKED_DAYS = """
ranked_days AS (
  SELECT *, date_diff('day', DATE '1990-01-01', obs_date) AS pos FROM set_daily
),
quote_documents AS (
  SELECT '^SET.BK' AS series_id, pos // 1000 AS part,
         to_json({'obs': list({'obs_date': CAST(obs_date AS VARCHAR), 'close': close, 'volume': volume} ORDER BY pos)})
           AS payload,
         to_json({'code': '^SET.BK'}) AS request_params
  FROM ranked_days GROUP BY ALL
)"""


def _quote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.set_daily(spark, sf_dir).select(
        F.lit("^SET.BK").alias("ticker"),
        "obs_date",
        "close",
        "volume",
        F.date_diff("obs_date", F.lit("1990-01-01").cast("date")).cast("bigint").alias("pos"),
    )
    return bronze.pack_payload(days, "ticker", ["obs_date", "close", "volume"], part_size=1000)


@check(
    "append_batch",
    f"""WITH {_ORDER_DOCUMENTS}, {inputs.SET_DAILY}, {_RANKED_DAYS}
    SELECT 'run-1' AS batch_id, 'BOT' AS source_api, series_id, part, payload, request_params,
           TIMESTAMP '2024-01-01 07:00:00' AS ingested_at FROM order_documents
    UNION ALL
    SELECT 'run-2', 'SET', series_id, part, payload, request_params, TIMESTAMP '2024-01-02 07:00:00'
    FROM quote_documents""",
)
def append_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    at = [F.to_timestamp_ntz(F.lit(f"2024-01-0{day} 07:00:00")) for day in (1, 2)]
    lake.append_batch(_order_documents(spark, sf_dir), path, "run-1", "BOT", at[0])
    lake.append_batch(_quote_documents(spark, sf_dir), path, "run-2", "SET", at[1])
    return lake.scan_parquet(spark, path)


@check("optional_source", f"WITH {inputs.OBS_LONG} SELECT * FROM obs_long")
def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = obs_raw(spark, sf_dir)
    absent = landed.optional_source(spark, f"{sf_dir}/no_such_source.parquet", raw.schema)
    return silver.dedupe_last(raw.unionByName(absent))


# --- source normalisation -----------------------------------------------------------------


@check(
    "normalize_monthly_series",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_date, o_totalprice AS value
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def normalize_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.normalize_monthly_series(
        table(spark, sf_dir, "orders").select(
            F.date_format("o_orderdate", "yyyy-MM").alias("period_start"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("value"),
        )
    )


@check(
    "normalize_event_snapshot",
    """WITH r AS (
      SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS effective_datetime, CAST(value AS VARCHAR) AS data,
             CASE WHEN event_type <> 'error' THEN props END AS news_text_th, event_type AS news_text_en, ts, value
      FROM events)
    SELECT CAST(ts AS DATE) AS obs_date, value, news_text_th AS news_th, news_text_en AS news_en,
           to_json({'effective_datetime': effective_datetime, 'data': data, 'news_text_th': news_text_th,
                    'news_text_en': news_text_en}) AS raw
    FROM r""",
)
def normalize_event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.normalize_event_snapshot(
        table(spark, sf_dir, "events").select(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("effective_datetime"),
            F.col("value").cast("string").alias("data"),
            F.when(F.col("event_type") != "error", F.col("props")).alias("news_text_th"),
            F.col("event_type").alias("news_text_en"),
        )
    )


@check(
    "normalize_period_series",
    """SELECT CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
)
def normalize_period_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.normalize_period_series(
        table(spark, sf_dir, "orders").select(
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("period"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"),
        )
    )


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations with NaN for one status and null for one priority."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("obs_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan")))
        .when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
        .alias("value"),
    )


@check(
    "drop_missing_value",
    """SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_orderdate >= DATE '1996-07-01'""",
)
def drop_missing_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.drop_missing_value(_with_gaps(spark, sf_dir), start="1996-07-01")


@check(
    "normalize_ohlc",
    """SELECT CAST(l_shipdate AS DATE) AS obs_date, max(l_extendedprice) AS close,
           CAST(sum(CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END)
             AS DOUBLE) AS volume
    FROM lineitem GROUP BY 1 HAVING volume > 0""",
)
def normalize_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    traded = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)
    quotes = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("Date"))
        .agg(
            F.max("l_extendedprice").alias("Close|^SET.BK"),
            F.sum(F.when(traded, F.col("l_quantity").cast("decimal(18,2)")).otherwise(0)).alias("Volume|^SET.BK"),
        )
    )
    return landed.normalize_ohlc(quotes)


# --- bronze ---------------------------------------------------------------------------------


@check("pack_payload", f"WITH {_ORDER_DOCUMENTS} SELECT * FROM order_documents")
def pack_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_documents(spark, sf_dir)


@check(
    "latest_batch",
    """WITH days AS (SELECT event_type AS series_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, event_id AS part,
                      props AS payload FROM events)
    SELECT * FROM days
    QUALIFY batch_id = max(batch_id) OVER (PARTITION BY series_id)""",
)
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of an event type is a batch."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"),
        F.to_date("ts").cast("string").alias("batch_id"),
        F.col("event_id").alias("part"),
        F.col("props").alias("payload"),
        F.col("ts").alias("ingested_at"),
    )
    return bronze.latest_batch(raw).select("series_id", "batch_id", "part", "payload")


@check(
    "explode_payload",
    f"""WITH {inputs.OBS_RAW}
    SELECT indicator_code AS series_id, pos // 10000 AS part,
           CAST(row_number() OVER (PARTITION BY indicator_code, pos // 10000 ORDER BY pos) - 1 AS INTEGER) AS pos,
           obs_date, value
    FROM obs_raw""",
)
def explode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.explode_payload(_order_documents(spark, sf_dir), schemas.VALUE_PAYLOAD)


@check(
    "scalar_payload",
    """SELECT event_type AS series_id, event_id AS part, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events""",
)
def scalar_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"), F.col("event_id").alias("part"), F.col("props").alias("payload")
    )
    return bronze.scalar_payload(raw, StructType([StructField("k", DoubleType())]), "series_id", "part")
