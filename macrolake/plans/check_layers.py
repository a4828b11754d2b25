"""Check queries: silver merges, monthly marts, views over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.functions.dates import month_bucket as month_of
from macrolake.functions.stats import exact_sum
from macrolake.operators import crossmart, monthly, refresh, silver
from macrolake.plans import inputs
from macrolake.plans.inputs import (
    AS_OF,
    SCALE,
    customer_obs,
    market_rows,
    obs_long,
    obs_raw,
    order_rows,
    set_daily,
    silver_rows,
    table,
)
from macrolake.plans.registry import check
from macrolake.session import shared_dir
from macrolake.sources.lake import replace_partitions, scan_parquet
from macrolake.sources.merge import BY_YEAR, kept, merge_by_year, with_year

_CUSTOMER = ["custkey"]


# --- silver -----------------------------------------------------------------------------------


@check(
    "wide_to_long",
    f"""WITH {inputs.SET_DAILY}
    SELECT obs_date, 'TH.SET_INDEX' AS indicator_code, 'points' AS unit, close AS value FROM set_daily
    UNION ALL SELECT obs_date, 'TH.SET_VOLUME', 'shares', volume FROM set_daily""",
)
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.wide_to_long(set_daily(spark, sf_dir), inputs.SET_FIELDS)


@check("dedupe_last", f"WITH {inputs.OBS_LONG} SELECT * FROM obs_long")
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedupe_last(obs_raw(spark, sf_dir))


def _status_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What silver already holds: the last order of each status and day."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("indicator_code"),
        F.to_date("o_orderdate").alias("obs_date"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
    )
    return silver.dedupe_last(orders).select(
        "*", F.lit("baht").alias("unit"), F.lit("D").alias("frequency"), F.lit("orders").alias("source"),
        F.lit("o_totalprice").alias("source_series_id"), F.to_date(F.lit("2024-01-01")).alias("ingested_at"),
    )


def _shipped_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new batch brings: line items by status and ship date, null on days without full-price returns."""
    returned = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_linestatus").alias("indicator_code"), F.to_date("l_shipdate").alias("obs_date"))
        .agg(exact_sum(F.when(returned, F.col("l_quantity")), SCALE).alias("value"))
        .select(
            "*", F.lit("pieces").alias("unit"), F.lit("D").alias("frequency"), F.lit("lineitem").alias("source"),
            F.lit("l_quantity").alias("source_series_id"), F.to_date(F.lit("2024-01-02")).alias("ingested_at"),
        )
    )


_UPSERTED = """WITH target AS (
      SELECT o_orderstatus AS indicator_code, CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value
      FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_orderstatus, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    batch AS (
      SELECT l_linestatus AS indicator_code, CAST(l_shipdate AS DATE) AS obs_date,
             CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R' AND l_discount = 0)
               AS DOUBLE) AS value
      FROM lineitem GROUP BY 1, 2)
    SELECT t.indicator_code, t.obs_date, CASE WHEN b.obs_date IS NULL THEN t.value ELSE b.value END AS value,
           'baht' AS unit, 'D' AS frequency, 'orders' AS source, 'o_totalprice' AS source_series_id,
           DATE '2024-01-01' AS ingested_at
    FROM target t LEFT JOIN batch b ON t.indicator_code = b.indicator_code AND t.obs_date = b.obs_date
    UNION ALL
    SELECT b.indicator_code, b.obs_date, b.value, 'pieces', 'D', 'lineitem', 'l_quantity', DATE '2024-01-02'
    FROM batch b ANTI JOIN target t ON t.indicator_code = b.indicator_code AND t.obs_date = b.obs_date"""


@check("upsert_value", _UPSERTED)
def upsert_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.upsert_value(_status_observations(spark, sf_dir), _shipped_observations(spark, sf_dir))


def _merged_by_year(target: DataFrame, batch: DataFrame, update: list[str]) -> DataFrame:
    """The merge as the jobs run it, on a stored table: once, and again with the same batch, which writes nothing."""
    path = shared_dir(target.sparkSession)
    stored = with_year(target)
    replace_partitions(stored, path, *BY_YEAR)
    for _ in range(2):
        merge_by_year(lambda: scan_parquet(target.sparkSession, path, stored.schema).select(*stored.columns), path, batch, update)
    return scan_parquet(target.sparkSession, path, stored.schema).select(*target.columns)


@check("upsert_value_by_year", _UPSERTED)
def upsert_value_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_by_year(_status_observations(spark, sf_dir), _shipped_observations(spark, sf_dir), silver.VALUE_ONLY)


_LAYERS = [silver.Layer("F", "BIS", "series-F"), silver.Layer("O", "BOT_STAT", "series-O"),
           silver.Layer("P", "BOT", "series-P")]


_LAYERED = """WITH layers AS (
      SELECT o_orderpriority AS indicator_code, CAST(o_orderdate AS DATE) AS obs_date, o_totalprice AS value,
             CASE o_orderstatus WHEN 'F' THEN 'BIS' WHEN 'O' THEN 'BOT_STAT' ELSE 'BOT' END AS source,
             'series-' || o_orderstatus AS source_series_id,
             CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS layer, o_orderkey AS pos
      FROM orders
      QUALIFY row_number() OVER (PARTITION BY indicator_code, obs_date ORDER BY layer DESC, pos DESC) = 1),
    target AS (
      SELECT CASE l_returnflag WHEN 'A' THEN '1-URGENT' WHEN 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END AS indicator_code,
             CAST(l_shipdate AS DATE) AS obs_date, max(l_extendedprice) AS value
      FROM lineitem GROUP BY 1, 2)
    SELECT coalesce(t.indicator_code, b.indicator_code) AS indicator_code, coalesce(t.obs_date, b.obs_date) AS obs_date,
           coalesce(b.value, t.value) AS value, CASE WHEN t.obs_date IS NULL THEN NULL ELSE 'percent' END AS unit,
           coalesce(b.source, 'OLD') AS source, coalesce(b.source_series_id, 'old') AS source_series_id
    FROM target t FULL JOIN layers b ON t.indicator_code = b.indicator_code AND t.obs_date = b.obs_date"""


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What silver holds, from line items, and three layers of orders, collapsed."""
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", "1-URGENT").when(flag == "N", "2-HIGH").otherwise("3-MEDIUM")
    target = (
        table(spark, sf_dir, "lineitem")
        .groupBy(code.alias("indicator_code"), F.to_date("l_shipdate").alias("obs_date"))
        .agg(F.max("l_extendedprice").alias("value"))
        .select(
            "*", F.lit("percent").alias("unit"), F.lit("OLD").alias("source"), F.lit("old").alias("source_series_id")
        )
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("indicator_code"),
        F.to_date("o_orderdate").alias("obs_date"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderstatus").alias("series_id"),
    )
    return target, silver.collapse_layers(rows, _LAYERS)


@check("layered_upsert", _LAYERED)
def layered_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.layered_upsert(*_layers(spark, sf_dir))


@check("layered_upsert_by_year", _LAYERED)
def layered_upsert_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_by_year(*_layers(spark, sf_dir), silver.VALUE_AND_SOURCE)


@check(
    "upsert_dim",
    """SELECT coalesce(s_suppkey, c_custkey) AS indicator_code, coalesce(s_name, 'customer') AS name_th,
           coalesce(c_name, s_name) AS name_en,
           CASE WHEN s_suppkey IS NULL THEN c_mktsegment ELSE 'supplier' END AS category
    FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""",
)
def upsert_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the known dimension rows, customers as the batch."""
    known = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("indicator_code"), F.col("s_name").alias("name_th"), F.col("s_name").alias("name_en"),
        F.lit("supplier").alias("category"),
    )
    batch = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("indicator_code"), F.lit("customer").alias("name_th"),
        F.col("c_name").alias("name_en"), F.col("c_mktsegment").alias("category"),
    )
    return silver.upsert_dim(known, batch)


_WIDE = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@check(
    "long_to_wide",
    f"""WITH {inputs.OBS_LONG}
    SELECT obs_date, {", ".join(f"max(value) FILTER (WHERE indicator_code = '{k}') AS {v}" for k, v in _WIDE.items())}
    FROM obs_long GROUP BY 1""",
)
def long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.long_to_wide(obs_long(spark, sf_dir), _WIDE)


@check(
    "select_series",
    f"WITH {inputs.OBS_LONG} SELECT * FROM obs_long WHERE indicator_code IN ('1-URGENT', '3-MEDIUM')",
)
def select_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.select_series(obs_long(spark, sf_dir), "1-URGENT", "3-MEDIUM")


# --- monthly marts ------------------------------------------------------------------------------

_MONTH = "CAST(date_trunc('month', obs_date) AS DATE)"


@check("month_bucket", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month FROM orders")
def month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", month_of(F.to_date("o_orderdate")).alias("obs_month"))


_PERIOD_LAST = f"""{inputs.OBS_LONG},
period_last AS (
  SELECT indicator_code, {_MONTH} AS obs_month, value FROM obs_long
  QUALIFY row_number() OVER (PARTITION BY indicator_code, {_MONTH} ORDER BY obs_date DESC) = 1
)"""


@check("period_last", f"WITH {_PERIOD_LAST} SELECT * FROM period_last")
def period_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.period_last(obs_long(spark, sf_dir))


@check(
    "period_sum",
    f"""WITH {inputs.OBS_LONG}
    SELECT indicator_code, {_MONTH} AS obs_month, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM obs_long GROUP BY 1, 2""",
)
def period_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.period_sum(obs_long(spark, sf_dir), scale=SCALE)


@check(
    "period_sum_any_scale",
    f"""WITH shifted AS (
      SELECT o_orderpriority AS indicator_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_month,
             CAST(round(o_totalprice) AS HUGEINT) * CAST(power(2, 3 * (o_orderkey % 7)) AS HUGEINT) AS whole FROM orders)
    SELECT indicator_code, obs_month, CAST(sum(whole) AS DOUBLE) / 512 AS value, CAST(sum(whole) AS DOUBLE) / 512 / count(*) AS average
    FROM shifted GROUP BY 1, 2""",
)
def period_sum_any_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prices times powers of two from 2^-9 to 2^9: the SQL adds whole numbers."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("indicator_code"),
        F.to_date("o_orderdate").alias("obs_date"),
        (F.expr("floor(o_totalprice + 0.5D)") * F.expr("power(2D, 3 * (o_orderkey % 7) - 9)")).alias("value"),
    )
    return monthly.monthly_facts(rows).select("indicator_code", "obs_month", F.col("sum").alias("value"), F.col("avg").alias("average"))


@check(
    "period_avg",
    f"""WITH {inputs.OBS_LONG}
    SELECT indicator_code, {_MONTH} AS obs_month,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS value
    FROM obs_long GROUP BY 1, 2""",
)
def period_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.period_avg(obs_long(spark, sf_dir), scale=SCALE)


@check(
    "mom_pct",
    f"""WITH {_PERIOD_LAST}
    SELECT *, 100 * (value / lag(value) OVER (PARTITION BY indicator_code ORDER BY obs_month) - 1) AS value_mom
    FROM period_last""",
)
def mom_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.mom_pct(monthly.period_last(obs_long(spark, sf_dir)), "value", "value_mom")


@check("set_monthly", f"WITH {inputs.MARTS} SELECT * FROM set_monthly")
def set_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.set_monthly(market_rows(spark, sf_dir), scale=SCALE)


@check("fx_monthly", f"WITH {inputs.MARTS} SELECT * FROM fx_monthly")
def fx_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.fx_monthly(order_rows(spark, sf_dir))


@check("cpi_monthly", f"WITH {inputs.MARTS} SELECT * FROM cpi_monthly")
def cpi_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.cpi_monthly(order_rows(spark, sf_dir), scale=SCALE)


@check("bond_monthly", f"WITH {inputs.MARTS} SELECT * FROM bond_monthly")
def bond_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.bond_monthly(market_rows(spark, sf_dir), scale=SCALE)


_CUSTOMER_MONTHS = f"""{inputs.CUSTOMER_OBS},
spine AS (
  SELECT custkey, CAST(unnest(generate_series(first_month, DATE '{AS_OF}', INTERVAL 1 MONTH)) AS DATE) AS obs_month
  FROM (SELECT custkey, date_trunc('month', min(obs_date)) AS first_month FROM customer_obs GROUP BY 1)
)"""


@check("month_spine", f"WITH {_CUSTOMER_MONTHS} SELECT * FROM spine")
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.month_spine(customer_obs(spark, sf_dir), AS_OF, _CUSTOMER)


@check(
    "asof_month_end",
    f"""WITH {_CUSTOMER_MONTHS}
    SELECT s.custkey, s.obs_month, o.value
    FROM spine s ASOF JOIN customer_obs o ON s.custkey = o.custkey AND last_day(s.obs_month) >= o.obs_date""",
)
def asof_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.asof_month_end(customer_obs(spark, sf_dir), AS_OF, _CUSTOMER)


@check("policy_rate_monthly", f"WITH {inputs.MARTS} SELECT * FROM policy_rate_monthly")
def policy_rate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.policy_rate_monthly(order_rows(spark, sf_dir), AS_OF)


@check(
    "series_bounds",
    f"""WITH {inputs.CUSTOMER_OBS}
    SELECT custkey, min(obs_date) AS first_date, max(obs_date) AS last_date FROM customer_obs GROUP BY 1""",
)
def series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.series_bounds(customer_obs(spark, sf_dir), _CUSTOMER)


# --- views over the marts -------------------------------------------------------------------------


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossmart.dashboard_from_silver(silver_rows(spark, sf_dir), AS_OF, scale=SCALE)


check("dashboard_monthly", f"WITH {inputs.DASHBOARD} SELECT * FROM dashboard_monthly")(dashboard)


@check("dashboard_from_marts", f"WITH {inputs.DASHBOARD} SELECT * FROM dashboard_monthly")
def dashboard_from_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that the gold views run."""
    market, orders = market_rows(spark, sf_dir), order_rows(spark, sf_dir)
    return crossmart.dashboard_monthly(
        monthly.set_monthly(market, scale=SCALE),
        monthly.fx_monthly(orders),
        monthly.policy_rate_monthly(orders, AS_OF),
        monthly.cpi_monthly(orders, scale=SCALE),
        monthly.bond_monthly(market, scale=SCALE),
    )


@check("dashboard_refresh", f"WITH {inputs.DASHBOARD} SELECT * FROM dashboard_monthly")
def dashboard_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard of a part of the rows at an earlier day, brought up to all rows by two batches."""
    rows = kept(silver_rows(spark, sf_dir))
    batch = F.expr("pmod(xxhash64(indicator_code, trunc(obs_date, 'month')), 3)")
    known, day = rows.filter(batch == 0), "1999-06-15"
    facts = kept(monthly.monthly_facts(known, scale=SCALE))
    board = kept(crossmart.dashboard_from_facts(facts, day))
    for number, as_of in ((1, "1998-01-31"), (2, AS_OF)):
        new = rows.filter(batch == number)
        known, touched = known.union(new), kept(refresh.touched_months(new))
        facts = kept(refresh.refreshed_facts(facts, known, touched, SCALE))
        affected = refresh.affected_months(facts, touched, as_of, day)
        board, day = kept(refresh.refreshed_dashboard(board, facts, affected, as_of)), as_of
    return board


@check(
    "real_rate_monthly",
    f"""WITH {inputs.MARTS}
    SELECT obs_month, policy_rate, cpi_yoy, policy_rate - cpi_yoy AS real_rate
    FROM policy_rate_monthly JOIN cpi_monthly USING (obs_month)""",
)
def real_rate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_rows(spark, sf_dir)
    return crossmart.real_rate_monthly(
        monthly.policy_rate_monthly(rows, AS_OF), monthly.cpi_monthly(rows, scale=SCALE)
    )


@check("corr_complete_case", f"WITH {inputs.CORRELATION} SELECT * FROM corr_complete_case")
def corr_complete_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossmart.corr_complete_case(dashboard(spark, sf_dir))


@check("corr_pairwise", f"WITH {inputs.CORRELATION} SELECT * FROM corr_pairwise")
def corr_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossmart.corr_pairwise(dashboard(spark, sf_dir))


_MATRIX = f"WITH {inputs.CORRELATION} SELECT * FROM corr_complete_case UNION ALL SELECT * FROM corr_pairwise"


@check("correlation_matrix", _MATRIX)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossmart.correlation_matrix(dashboard(spark, sf_dir))


@check("corr_ranked", f"SELECT * FROM ({_MATRIX}) ORDER BY abs(correlation) DESC NULLS FIRST, var1, var2")
def corr_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossmart.corr_ranked(crossmart.correlation_matrix(dashboard(spark, sf_dir)))
