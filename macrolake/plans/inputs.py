"""Series derived from the order-management test tables, in Spark and in SQL.

The operators work on series of observations; the test tables hold orders and
line items. Each input is defined twice, as a DataFrame and as a common table
expression, and uses every row of its tables.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.functions.stats import exact_sum
from macrolake.operators import crossmart
from macrolake.operators.silver import Field, Layer, collapse_layers, dedupe_last, wide_to_long
from macrolake.sources.lake import scan_parquet

#: The day on which the check queries are evaluated.
AS_OF = "2001-12-31"
#: Prices and quantities of the test tables have two decimals.
SCALE = 2

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


#: Declared schemas of the test tables: a scan starts without a job that reads file footers.
TABLE_SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", TABLE_SCHEMAS[name])


def _day(column: str) -> Column:
    return F.col(column).cast("date")


# --- observations by order priority -----------------------------------------------------


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; several orders share an (indicator, day) key."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("indicator_code"),
        _day("o_orderdate").alias("obs_date"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
    )


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_last(obs_raw(spark, sf_dir))


OBS_RAW = """
obs_raw AS (
  SELECT o_orderpriority AS indicator_code, CAST(o_orderdate AS DATE) AS obs_date,
         o_totalprice AS value, o_orderkey AS pos
  FROM orders
)"""

OBS_LONG = f"""{OBS_RAW},
obs_long AS (
  SELECT indicator_code, obs_date, value FROM obs_raw
  QUALIFY row_number() OVER (PARTITION BY indicator_code, obs_date ORDER BY pos DESC) = 1
)"""


# --- sparse series: one per customer ------------------------------------------------------


def customer_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About ten observations per customer over seven years: most months have none."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"),
        _day("o_orderdate").alias("obs_date"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
    )
    return dedupe_last(orders, keys=["custkey", "obs_date"])


CUSTOMER_OBS = """
customer_obs AS (
  SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1
)"""


# --- daily market and rate series ---------------------------------------------------------

SET_FIELDS = [
    Field("close", "TH.SET_INDEX", "points"),
    Field("volume", "TH.SET_VOLUME", "shares"),
]
_DAILY_FIELDS = [*SET_FIELDS, Field("bond", "TH.BOND_10Y", "percent")]

#: Order priorities as sources: one plain series each for FX and CPI, three layers for the policy rate.
_ORDER_LAYERS = [
    Layer("1-URGENT", "FRED", "DEXTHUS"),
    Layer("3-MEDIUM", "IMF", "IMF/IFS/M.TH.PCPI_PC_CP_A_PT"),
    Layer("5-LOW", "BIS", "BIS/WS_CBPOL/M.TH"),
    Layer("4-NOT SPECIFIED", "BOT_STAT", "FMRTINTM00262"),
    Layer("2-HIGH", "BOT", "policy_rate"),
]


def set_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(obs_date, close, volume, bond) from line items by ship date."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_day("l_shipdate").alias("obs_date"))
        .agg(
            F.max("l_extendedprice").alias("close"),
            exact_sum("l_quantity", SCALE).alias("volume"),
            exact_sum("l_discount", SCALE).alias("bond"),
        )
    )


_SILVER = ["indicator_code", "obs_date", "value"]


def market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index, volume and bond yield as silver rows: one scan of the line items."""
    return wide_to_long(set_daily(spark, sf_dir), _DAILY_FIELDS).select(_SILVER)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange rate, inflation and policy rate as silver rows: one scan of the orders."""
    code = (
        F.when(F.col("indicator_code") == "1-URGENT", "FX.USDTHB")
        .when(F.col("indicator_code") == "3-MEDIUM", "TH.CPI_YOY")
        .otherwise("TH.POLICY_RATE")
    )
    tagged = obs_raw(spark, sf_dir).withColumn("series_id", F.col("indicator_code")).withColumn("indicator_code", code)
    return collapse_layers(tagged, _ORDER_LAYERS).select(_SILVER)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six indicators as (indicator_code, obs_date, value)."""
    return market_rows(spark, sf_dir).unionByName(order_rows(spark, sf_dir))


SET_DAILY = """
set_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS obs_date, max(l_extendedprice) AS close,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS bond
  FROM lineitem GROUP BY 1
)"""

SILVER = f"""{SET_DAILY},
order_obs AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'FX.USDTHB' WHEN '3-MEDIUM' THEN 'TH.CPI_YOY'
              ELSE 'TH.POLICY_RATE' END AS indicator_code,
         CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value, o_orderkey AS pos,
         CASE o_orderpriority WHEN '2-HIGH' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 ELSE 1 END AS layer
  FROM orders
),
silver AS (
  SELECT 'TH.SET_INDEX' AS indicator_code, obs_date, close AS value FROM set_daily
  UNION ALL SELECT 'TH.SET_VOLUME', obs_date, volume FROM set_daily
  UNION ALL SELECT 'TH.BOND_10Y', obs_date, bond FROM set_daily
  UNION ALL (
    SELECT indicator_code, obs_date, value FROM order_obs
    QUALIFY row_number() OVER (PARTITION BY indicator_code, obs_date ORDER BY layer DESC, pos DESC) = 1
  )
)"""

MARTS = f"""{SILVER},
market_months AS (
  SELECT CAST(date_trunc('month', obs_date) AS DATE) AS obs_month, count(*) FILTER (WHERE indicator_code = 'TH.SET_INDEX') AS days,
         arg_max(value, obs_date) FILTER (WHERE indicator_code = 'TH.SET_INDEX') AS set_close,
         CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE indicator_code = 'TH.SET_VOLUME') AS DOUBLE) AS set_volume
  FROM silver WHERE indicator_code IN ('TH.SET_INDEX', 'TH.SET_VOLUME') GROUP BY ALL
),
set_monthly AS (
  SELECT obs_month, set_close, set_volume, 100 * (set_close / lag(set_close) OVER months - 1) AS set_mom
  FROM market_months WHERE days > 0 WINDOW months AS (ORDER BY obs_month)
),
fx_monthly AS (
  SELECT obs_month, usdthb, 100 * (usdthb / lag(usdthb) OVER (ORDER BY obs_month) - 1) AS usdthb_mom
  FROM (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS obs_month, arg_max(value, obs_date) AS usdthb
        FROM silver WHERE indicator_code = 'FX.USDTHB' GROUP BY 1)
),
policy_months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', min(obs_date)), DATE '{AS_OF}', INTERVAL 1 MONTH)) AS DATE) AS obs_month
  FROM silver WHERE indicator_code = 'TH.POLICY_RATE'
),
policy_rate_monthly AS (
  SELECT m.obs_month, s.value AS policy_rate
  FROM policy_months m
  ASOF JOIN (SELECT * FROM silver WHERE indicator_code = 'TH.POLICY_RATE') s ON last_day(m.obs_month) >= s.obs_date
),
cpi_monthly AS (
  SELECT CAST(date_trunc('month', obs_date) AS DATE) AS obs_month,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS cpi_yoy
  FROM silver WHERE indicator_code = 'TH.CPI_YOY' GROUP BY 1
),
bond_monthly AS (
  SELECT CAST(date_trunc('month', obs_date) AS DATE) AS obs_month,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS bond_10y
  FROM silver WHERE indicator_code = 'TH.BOND_10Y' GROUP BY 1
)"""

_CELLS = [c for c in crossmart.DASHBOARD_COLUMNS if c not in ("obs_month", "real_rate")]

#: All marts below each other, folded to one row for each month.
DASHBOARD = f"""{MARTS},
folded AS (
  SELECT obs_month, {", ".join(f"max({c}) AS {c}" for c in _CELLS)}
  FROM (FROM set_monthly UNION ALL BY NAME FROM fx_monthly UNION ALL BY NAME FROM policy_rate_monthly
        UNION ALL BY NAME FROM cpi_monthly UNION ALL BY NAME FROM bond_monthly)
  GROUP BY obs_month
),
dashboard_monthly AS (SELECT *, policy_rate - cpi_yoy AS real_rate FROM folded)"""

_COMPLETE = list(itertools.combinations(crossmart.COMPLETE_CASE, 2))
_PAIRS = [(a, b, True) for a, b in _COMPLETE] + [(a, b, False) for a, b in crossmart.PAIRWISE]
_VARIABLES = sorted({v for a, b, _ in _PAIRS for v in (a, b)})

#: One row for each month and variable, joined with itself for each pair of names.
CORRELATION = f"""{DASHBOARD},
long AS (
  SELECT obs_month, cell.name AS name, cell.x AS x
  FROM (SELECT obs_month, unnest([{", ".join(f"{{'name': '{v}', 'x': {v}}}" for v in _VARIABLES)}]) AS cell FROM dashboard_monthly)
  WHERE cell.x IS NOT NULL
),
whole AS (
  SELECT obs_month FROM long WHERE name IN ({", ".join(f"'{v}'" for v in crossmart.COMPLETE_CASE)})
  GROUP BY obs_month HAVING count(*) = {len(crossmart.COMPLETE_CASE)}
),
pairs(var1, var2, complete) AS (VALUES {", ".join(str(p) for p in _PAIRS)}),
joint AS (
  SELECT a.obs_month, a.name AS var1, b.name AS var2, a.x AS x1, b.x AS x2, whole.obs_month IS NOT NULL AS in_whole
  FROM long AS a JOIN long AS b USING (obs_month) LEFT JOIN whole USING (obs_month)
),
paired AS (
  SELECT p.var1, p.var2, p.complete, round(corr(x1, x2), 3) AS correlation, count(x1) AS n
  FROM pairs AS p LEFT JOIN joint AS j ON p.var1 = j.var1 AND p.var2 = j.var2 AND (in_whole OR NOT p.complete)
  GROUP BY ALL
),
corr_complete_case AS (SELECT var1, var2, correlation, n FROM paired WHERE complete),
corr_pairwise AS (SELECT var1, var2, correlation, n FROM paired WHERE NOT complete)"""


# --- monthly panels for forecasting -------------------------------------------------------


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(indicator, obs_month, value): shipped value per supplier and month."""
    return _panel(table(spark, sf_dir, "lineitem"), F.col("l_suppkey").cast("string"), "l_shipdate", "l_extendedprice")


def priority_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(indicator, obs_month, value): order value per priority and month."""
    return _panel(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), "o_orderdate", "o_totalprice")


def _panel(rows: DataFrame, indicator: Column, date: str, value: str) -> DataFrame:
    return rows.groupBy(indicator.alias("indicator"), F.trunc(_day(date), "month").alias("obs_month")).agg(
        exact_sum(value, SCALE).alias("value")
    )


SUPPLIER_PANEL = """
panel AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS indicator, CAST(date_trunc('month', l_shipdate) AS DATE) AS obs_month,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2
)"""

PRIORITY_PANEL = """
panel AS (
  SELECT o_orderpriority AS indicator, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2
)"""

#: The smoothing recursion over ``panel`` as recursive SQL, one row per series and grid point.
#: ``fits`` has the best grid point of each series; ``ahead`` the unrounded forecasts.
HOLT_WINTERS = """
points AS (
  SELECT indicator, obs_month, value, row_number() OVER (PARTITION BY indicator ORDER BY obs_month) AS t
  FROM panel
),
series AS (
  SELECT indicator, count(*) AS n, max(obs_month) AS last_month, list(value ORDER BY t) AS y
  FROM points GROUP BY 1 HAVING count(*) >= 24
),
weights AS (SELECT unnest([0.0::DOUBLE, 0.1::DOUBLE, 0.3::DOUBLE, 0.6::DOUBLE, 0.9::DOUBLE, 1.0::DOUBLE]) AS w),
averages AS (
  SELECT *, list_transform(range(7, 12 * cycles - 5), lambda t: list_reduce(
      [0.5 * y[t - 6]] || y[t - 5 : t + 5] || [0.5 * y[t + 6]], lambda a, b: a + b) / 12) AS centred
  FROM (SELECT *, CAST(n // 12 AS INTEGER) AS cycles FROM series)
),
lines AS (
  SELECT *, list_transform(range(1, 13), lambda p: list_reduce(list_transform(range(0, cycles - 1), lambda k:
      y[p + 12 * (k + if(p <= 6, 1, 0))] - centred[p + 12 * (k + if(p <= 6, 1, 0)) - 6]), lambda a, b: a + b)
      / (cycles - 1)) AS raw,
    list_reduce(list_transform(range(1, 13), lambda i: (i - 6.5::DOUBLE) * centred[i]), lambda a, b: a + b) / 143 AS slope,
    list_reduce(centred[1:12], lambda a, b: a + b) / 12 AS middle
  FROM averages
),
starts AS (
  SELECT indicator, n, last_month, y, middle - 12.5::DOUBLE * slope AS l0, slope AS b0,
         list_transform(raw, lambda r: r - list_reduce(raw, lambda a, b: a + b) / 12) AS s0
  FROM lines
),
steps AS (
  SELECT indicator, n, last_month, y, a.w AS alpha, b.w AS beta, c.w AS gamma, CAST(0 AS BIGINT) AS t,
         l0 AS level, b0 AS trend, s0 AS seasonals, CAST(0 AS DOUBLE) AS sum_error, CAST(0 AS DOUBLE) AS sse
  FROM starts, weights a, weights b, weights c
  UNION ALL
  SELECT indicator, n, last_month, y, alpha, beta, gamma, t + 1, new_level,
         beta * (new_level - level) + (1 - beta) * trend,
         list_append(seasonals[2:12], gamma * (value - base) + (1 - gamma) * oldest),
         sum_error + (value - (base + oldest)),
         sse + (value - (base + oldest)) * (value - (base + oldest))
  FROM (
    SELECT *, alpha * (value - oldest) + (1 - alpha) * base AS new_level
    FROM (SELECT *, y[t + 1] AS value, seasonals[1] AS oldest, level + trend AS base FROM steps WHERE t < n)
  )
),
fits AS (
  SELECT indicator, n, last_month, alpha, beta, gamma, sse, level, trend, seasonals,
         sqrt(greatest((sse - sum_error * sum_error / n) / (n - 1), 0)) AS sigma
  FROM steps WHERE t = n
  QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY sse, alpha, beta, gamma) = 1
),
ahead AS (
  SELECT indicator, sigma, CAST(date_trunc('month', last_month) + to_months(CAST(h AS INTEGER)) AS DATE) AS obs_month,
         level + h * trend + seasonals[(h - 1) % 12 + 1] AS raw
  FROM fits, (SELECT unnest(range(1, 7)) AS h)
),
bands AS (
  SELECT indicator, obs_month, round_even(raw, 2) AS yhat, round_even(raw - 1.96 * sigma, 2) AS yhat_lower,
         round_even(raw + 1.96 * sigma, 2) AS yhat_upper
  FROM ahead
),
forecast_monthly AS (
  SELECT obs_month, indicator, yhat, yhat_lower, yhat_upper, true AS is_forecast, 'holt-winters' AS model FROM bands
  UNION ALL
  SELECT obs_month, indicator, value, NULL, NULL, false, NULL FROM panel
)"""
