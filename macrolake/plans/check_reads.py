"""Check queries: forecasts, quality gates, serving queries, text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from macrolake.functions import text
from macrolake.operators import crossmart, forecast, monthly, quality, serving
from macrolake.plans import inputs
from macrolake.plans.check_layers import dashboard
from macrolake.plans.inputs import AS_OF, SCALE, market_rows, priority_panel, silver_rows, supplier_panel, table
from macrolake.plans.registry import check

# --- forecasts ------------------------------------------------------------------------------

_SUPPLIER_FIT = f"WITH RECURSIVE {inputs.SUPPLIER_PANEL}, {inputs.HOLT_WINTERS}"
_PRIORITY_FIT = f"WITH RECURSIVE {inputs.PRIORITY_PANEL}, {inputs.HOLT_WINTERS}"


@check(
    "actuals_series",
    f"""WITH {inputs.DASHBOARD}
    SELECT 'TH.SET_INDEX' AS indicator, obs_month, set_close AS value FROM dashboard_monthly WHERE set_close IS NOT NULL
    UNION ALL
    SELECT 'FX.USDTHB', obs_month, usdthb FROM dashboard_monthly WHERE usdthb IS NOT NULL""",
)
def actuals_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = monthly.set_monthly(market_rows(spark, sf_dir), scale=SCALE)
    rate = monthly.fx_monthly(inputs.order_rows(spark, sf_dir))
    return forecast.actuals_series(index, "set_close", "TH.SET_INDEX").unionByName(
        forecast.actuals_series(rate, "usdthb", "FX.USDTHB")
    )


@check(
    "hw_fit",
    f"""{_SUPPLIER_FIT}
    SELECT indicator, CAST(n AS INTEGER) AS n, last_month, alpha, beta, gamma, sse, level, trend, sigma FROM fits""",
)
def hw_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.hw_fit(supplier_panel(spark, sf_dir)).drop("seasonals")


@check(
    "hw_fit_optimised",
    f"""WITH {inputs.SUPPLIER_PANEL}
    SELECT indicator, CAST(count(*) AS INTEGER) AS n, max(obs_month) AS last_month, true AS not_above_grid, true AS within_bounds
    FROM panel GROUP BY 1 HAVING count(*) >= 24""",
)
def hw_fit_optimised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the optimiser promises of every series; the numbers are tested against other minimisers."""
    panel = supplier_panel(spark, sf_dir)
    grid = forecast.hw_fit(panel).select("indicator", F.col("sse").alias("grid_sse"))
    inside = F.lit(True)
    for weight in ("alpha", "beta", "gamma"):
        inside = inside & F.col(weight).between(0, 1)
    return forecast.hw_fit_optimised(panel).join(grid, "indicator").select(
        "indicator", "n", "last_month", (F.col("sse") <= F.col("grid_sse")).alias("not_above_grid"), inside.alias("within_bounds")
    )


@check("hw_forecast", f"{_SUPPLIER_FIT} SELECT indicator, obs_month, yhat FROM bands")
def hw_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.hw_forecast(forecast.hw_fit(supplier_panel(spark, sf_dir)))


@check("hw_band", f"{_SUPPLIER_FIT} SELECT * FROM bands")
def hw_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.hw_band(forecast.hw_fit(supplier_panel(spark, sf_dir)))


def _forecast(panel: DataFrame) -> DataFrame:
    at = F.to_timestamp_ntz(F.lit("2024-01-01 08:00:00"))
    return forecast.forecast_monthly(panel, forecast.hw_band(forecast.hw_fit(panel)), at)


@check(
    "forecast_monthly",
    f"{_SUPPLIER_FIT} SELECT *, TIMESTAMP '2024-01-01 08:00:00' AS generated_at FROM forecast_monthly",
)
def forecast_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(supplier_panel(spark, sf_dir))


# --- quality gates ----------------------------------------------------------------------------


def _report_sql(
    relation: str, suite: str, by: str, rules: list[tuple[str, str | None, str]], ctes: str = ""
) -> str:
    """One SELECT per rule: name, column, and the SQL aggregate that counts failures."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    lines = [
        f"""SELECT {keys}'{suite}' AS suite, '{rule}' AS rule, {f"'{column}'" if column else "CAST(NULL AS VARCHAR)"}
        AS column_name, count(*) AS n_rows, CAST({failed} AS BIGINT) AS n_failed, coalesce(({failed}) = 0, false) AS passed
        FROM {relation} {group}"""
        for rule, column, failed in rules
    ]
    return (f"WITH {ctes} " if ctes else "") + " UNION ALL ".join(lines)


_PRICE_RULES = [
    ("in_range", "o_totalprice", "count(*) FILTER (WHERE NOT o_totalprice BETWEEN 2000 AND 400000)"),
    ("non_negative", "o_totalprice", "count(*) FILTER (WHERE o_totalprice < 0)"),
    ("positive", "o_totalprice", "count(*) FILTER (WHERE o_totalprice <= 0)"),
]


@check("dq_range", _report_sql("orders", "prices", "o_orderpriority", _PRICE_RULES))
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        quality.in_range("o_totalprice", 2000, 400000),
        quality.non_negative("o_totalprice"),
        quality.positive("o_totalprice"),
    ]
    return quality.dq_report(table(spark, sf_dir, "orders"), "prices", rules, ["o_orderpriority"])


@check(
    "dq_not_null",
    _report_sql(
        "orders",
        "gaps",
        "o_orderstatus",
        [
            ("not_null", "value", "count(*) FILTER (WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW')"),
            (
                "in_range",
                "value",
                """count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
                   AND o_totalprice NOT BETWEEN 0 AND 300000)""",
            ),
        ],
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).when(
        F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")
    )
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", value.alias("value"))
    rules = [quality.not_null("value"), quality.in_range("value", 0, 300000)]
    return quality.dq_report(rows, "gaps", rules, ["o_orderstatus"])


@check(
    "dq_dtype",
    _report_sql(
        "lineitem",
        "types",
        "l_linestatus",
        [("has_type", "l_quantity", "0"), ("has_type", "l_linenumber", "1"), ("has_type", "l_absent", "1"),
         ("not_null", "l_absent", "NULL")],
    ),
)
def dq_dtype(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [quality.has_type(c, DoubleType()) for c in ("l_quantity", "l_linenumber", "l_absent")]
    rules.append(quality.not_null("l_absent"))
    return quality.dq_report(table(spark, sf_dir, "lineitem"), "types", rules, ["l_linestatus"])


@check(
    "dq_min_rows",
    _report_sql("orders", "rows", "o_custkey", [("min_rows", None, "greatest(10 - count(*), 0)")]),
)
def dq_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(table(spark, sf_dir, "orders"), "rows", [quality.min_rows(10)], ["o_custkey"])


@check(
    "dq_exact_rows",
    _report_sql(
        "panel", "months", "indicator", [("exact_rows", None, "abs(count(*) - 83)")], inputs.SUPPLIER_PANEL
    ),
)
def dq_exact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(supplier_panel(spark, sf_dir), "months", [quality.exact_rows(83)], ["indicator"])


#: A series of each supplier is expected, and one of each customer; customers without a supplier's number are absent.
_EXPECTED = """
months AS (SELECT indicator, count(*) AS n FROM panel GROUP BY 1),
wanted AS (SELECT CAST(s_suppkey AS VARCHAR) AS indicator FROM supplier UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer),
counted AS (SELECT indicator, coalesce(n, 0) AS n FROM months FULL JOIN wanted USING (indicator))"""


@check(
    "dq_expected_groups",
    f"""WITH {inputs.SUPPLIER_PANEL}, {_EXPECTED},
    rules(rule, column_name) AS (VALUES ('exact_rows', NULL), ('min_rows', NULL), ('not_null', 'value'))
    SELECT indicator, 'complete' AS suite, rule, column_name, n AS n_rows,
           CASE rule WHEN 'exact_rows' THEN abs(n - 83) WHEN 'min_rows' THEN greatest(24 - n, 0) ELSE 0 END AS n_failed,
           CASE rule WHEN 'exact_rows' THEN n = 83 WHEN 'min_rows' THEN n >= 24 ELSE true END AS passed
    FROM counted, rules""",
)
def dq_expected_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(name: str, column: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(column).cast("string").alias("indicator"))

    wanted = keys("supplier", "s_suppkey").union(keys("customer", "c_custkey"))
    rules = [quality.exact_rows(83), quality.min_rows(24), quality.not_null("value")]
    return quality.dq_report(supplier_panel(spark, sf_dir), "complete", rules, ["indicator"], wanted)


@check(
    "month_gaps",
    f"""WITH {inputs.CUSTOMER_OBS},
    numbered AS (
      SELECT DISTINCT custkey, CAST(12 * year(obs_date) + month(obs_date) - 1 AS BIGINT) AS m FROM customer_obs),
    islands AS (
      SELECT custkey, min(m) AS first_m, max(m) AS last_m
      FROM (SELECT custkey, m, m - row_number() OVER (PARTITION BY custkey ORDER BY m) AS island FROM numbered) GROUP BY custkey, island),
    gaps AS (
      SELECT custkey, last_m + 1 AS a, lead(first_m) OVER (PARTITION BY custkey ORDER BY first_m) - 1 AS b FROM islands)
    SELECT custkey, make_date(a // 12, a % 12 + 1, 1) AS gap_from, make_date(b // 12, b % 12 + 1, 1) AS gap_to,
           CAST(b - a + 1 AS INTEGER) AS n_months
    FROM gaps WHERE b IS NOT NULL""",
)
def month_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.month_gaps(inputs.customer_obs(spark, sf_dir), ["custkey"], "obs_date")


@check(
    "dq_freshness",
    _report_sql(
        "customer_obs",
        "fresh",
        "custkey",
        [("fresh", "obs_date", f"greatest(date_diff('day', max(obs_date), DATE '{AS_OF}') - 365, 0)")],
        inputs.CUSTOMER_OBS,
    ),
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [quality.fresh("obs_date", AS_OF, 365)]
    return quality.dq_report(inputs.customer_obs(spark, sf_dir), "fresh", rules, ["custkey"])


@check(
    "dq_band_order",
    _report_sql(
        "lineitem",
        "bands",
        "l_linestatus",
        [
            (
                "band_order",
                "l_discount",
                """count(*) FILTER (WHERE NOT coalesce(l_tax <= l_discount AND
                   l_discount <= CASE WHEN l_returnflag <> 'R' THEN l_tax + 0.05 END, false))""",
            )
        ],
    ),
)
def dq_band_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = F.when(F.col("l_returnflag") != "R", F.col("l_tax") + 0.05)
    rows = table(spark, sf_dir, "lineitem").withColumn("upper", upper)
    return quality.dq_report(rows, "bands", [quality.band_order("l_tax", "l_discount", "upper")], ["l_linestatus"])


@check(
    "dq_distinct_min",
    _report_sql(
        "obs_raw",
        "days",
        "indicator_code",
        [("min_distinct", "obs_date", "greatest(1720 - count(DISTINCT obs_date), 0)")],
        inputs.OBS_RAW,
    ),
)
def dq_distinct_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [quality.min_distinct("obs_date", 1720)]
    return quality.dq_report(inputs.obs_raw(spark, sf_dir), "days", rules, ["indicator_code"])


@check(
    "dq_conditional_range",
    _report_sql(
        "silver",
        "set",
        "",
        [
            ("min_distinct", "obs_date", "greatest(100 - count(DISTINCT obs_date), 0)"),
            ("not_null", "value", "count(*) FILTER (WHERE value IS NULL)"),
            (
                "conditional_range",
                "value",
                "count(*) FILTER (WHERE indicator_code = 'TH.SET_INDEX' AND value NOT BETWEEN 50 AND 5000)",
            ),
            ("non_negative", "value", "count(*) FILTER (WHERE value < 0)"),
            ("fresh", "obs_date", f"greatest(date_diff('day', max(obs_date), DATE '{AS_OF}') - 7, 0)"),
        ],
        inputs.SILVER,
    ),
)
def dq_conditional_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(silver_rows(spark, sf_dir), "set", quality.set_long_suite(AS_OF))


@check(
    "dq_forecast_sanity",
    # The report SELECTs follow the last expression of the WITH list.
    f"""{_PRIORITY_FIT},
    checked AS (
      SELECT b.*, a.last_value FROM bands b
      JOIN (SELECT indicator, arg_max(value, obs_month) AS last_value FROM panel GROUP BY 1) a USING (indicator))
    """
    + _report_sql(
        "checked",
        "sanity",
        "indicator",
        [
            ("positive", "yhat", "count(*) FILTER (WHERE yhat <= 0)"),
            ("within_factor", "yhat", "count(*) FILTER (WHERE yhat NOT BETWEEN last_value / 3 AND last_value * 3)"),
            ("band_order", "yhat", "count(*) FILTER (WHERE NOT (yhat_lower <= yhat AND yhat <= yhat_upper))"),
            ("exact_rows", None, "abs(count(*) - 6)"),
        ],
    ),
)
def dq_forecast_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = priority_panel(spark, sf_dir)
    rows = quality.with_last_actual(forecast.hw_band(forecast.hw_fit(panel)), panel)
    rules = [*quality.forecast_sanity_suite(), quality.exact_rows(forecast.PERIODS)]
    return quality.dq_report(rows, "sanity", rules, ["indicator"])


@check("dq_enforce", f"WITH {inputs.MARTS} SELECT * FROM set_monthly")
def dq_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate in front of a mart: the mart is only built when every rule passes."""
    rows = market_rows(spark, sf_dir)
    rules = [quality.not_null("value"), quality.non_negative("value"), quality.min_rows(100)]
    quality.dq_enforce(quality.dq_report(rows, "silver", rules))
    return monthly.set_monthly(rows, scale=SCALE)


# --- serving ------------------------------------------------------------------------------------

_DASHBOARD = f"WITH {inputs.DASHBOARD}"


@check("gold_dashboard", f"{_DASHBOARD} SELECT * FROM dashboard_monthly ORDER BY obs_month")
def gold_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.gold_dashboard(dashboard(spark, sf_dir))


@check(
    "gold_forecast",
    f"""{_PRIORITY_FIT} SELECT obs_month, yhat, yhat_lower, yhat_upper, is_forecast FROM forecast_monthly
    WHERE indicator = '1-URGENT' ORDER BY obs_month, is_forecast""",
)
def gold_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.gold_forecast(_forecast(priority_panel(spark, sf_dir)), "1-URGENT")


@check("latest_n_rows", f"{_DASHBOARD} SELECT * FROM dashboard_monthly ORDER BY obs_month DESC LIMIT 3")
def latest_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_n_rows(dashboard(spark, sf_dir), 3)


def _latest_stat_sql(metric: str, change: str) -> str:
    return f"""(SELECT '{metric}' AS metric, max(obs_month) AS obs_month, arg_max({metric}, obs_month) AS value,
      arg_max(ROW({change}), obs_month)[1] AS mom,
      CASE WHEN mom >= 0 THEN 'up' WHEN mom < 0 THEN 'down' END AS direction
      FROM dashboard_monthly WHERE {metric} IS NOT NULL)"""


@check(
    "latest_stats",
    f"{_DASHBOARD} "
    + " UNION ALL ".join(
        _latest_stat_sql(metric, change or "CAST(NULL AS DOUBLE)")
        for metric, change in serving.HEADLINE_METRICS.items()
    ),
)
def latest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_stats(dashboard(spark, sf_dir))


@check(
    "month_range",
    f"""{_DASHBOARD} SELECT * FROM dashboard_monthly
    WHERE obs_month BETWEEN DATE '1995-01-01' AND DATE '2000-06-01'""",
)
def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.month_range(dashboard(spark, sf_dir), "1990-05-17", "2000-06-15")


@check(
    "trim_null_edges",
    f"""{_DASHBOARD} SELECT obs_month, real_rate FROM dashboard_monthly
    WHERE obs_month BETWEEN (SELECT min(obs_month) FROM dashboard_monthly WHERE real_rate IS NOT NULL)
                        AND (SELECT max(obs_month) FROM dashboard_monthly WHERE real_rate IS NOT NULL)""",
)
def trim_null_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.trim_null_edges(dashboard(spark, sf_dir), "real_rate")


_FORECAST_COLUMNS = "indicator, obs_month, yhat, yhat_lower, yhat_upper, is_forecast"
_POSITIONS = f"""{_PRIORITY_FIT},
positions AS (
  SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY obs_month, is_forecast) AS i FROM forecast_monthly
)"""


@check(
    "forecast_window",
    f"""{_POSITIONS} SELECT {_FORECAST_COLUMNS} FROM positions p
    WHERE i >= (SELECT min(i) - 12 FROM positions q WHERE q.indicator = p.indicator AND q.is_forecast)""",
)
def forecast_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = serving.forecast_window(_forecast(priority_panel(spark, sf_dir)))
    return window.drop("model", "generated_at")


@check(
    "forecast_plot_series",
    f"""{_POSITIONS},
    last_actual AS (SELECT indicator, max(i) AS last_i FROM positions WHERE NOT is_forecast GROUP BY 1)
    SELECT indicator, obs_month, CASE WHEN NOT is_forecast THEN yhat END AS actual,
           CASE WHEN is_forecast OR i = last_i THEN yhat END AS forecast,
           CASE WHEN is_forecast THEN yhat_upper WHEN i = last_i THEN yhat END AS upper,
           CASE WHEN is_forecast THEN yhat_lower WHEN i = last_i THEN yhat END AS lower
    FROM positions JOIN last_actual USING (indicator)""",
)
def forecast_plot_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.forecast_plot_series(_forecast(priority_panel(spark, sf_dir)))


@check(
    "extreme_month",
    f"""{_DASHBOARD}
    SELECT CAST(year(obs_month) AS INTEGER) AS year, obs_month, set_close FROM dashboard_monthly
    WHERE set_close IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY year(obs_month) ORDER BY set_close DESC, obs_month) = 1""",
)
def extreme_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.extreme_month(dashboard(spark, sf_dir), "set_close")


@check(
    "preview_with_total",
    f"""WITH {inputs.CUSTOMER_OBS}
    SELECT *, (SELECT count(*) FROM customer_obs) AS total_rows FROM customer_obs
    ORDER BY custkey, obs_date LIMIT 12""",
)
def preview_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.preview_with_total(inputs.customer_obs(spark, sf_dir), ["custkey", "obs_date"])


@check("actual_vs_forecast", f"{_PRIORITY_FIT} SELECT {_FORECAST_COLUMNS} FROM forecast_monthly WHERE is_forecast")
def actual_vs_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _forecast(priority_panel(spark, sf_dir)).drop("model", "generated_at")
    return serving.actual_vs_forecast(rows, is_forecast=True)


@check(
    "guarded_gold_query",
    f"""WITH {inputs.CORRELATION}
    SELECT CAST(year(obs_month) AS INTEGER) AS year, max(usdthb) AS highest, count(real_rate) AS months
    FROM dashboard_monthly WHERE usdthb IS NOT NULL GROUP BY 1""",
)
def guarded_gold_query(spark: SparkSession, sf_dir: str) -> DataFrame:

    def gold(session: SparkSession) -> dict[str, DataFrame]:
        marts = dashboard(session, sf_dir)
        return {"dashboard_monthly": marts, "correlation_matrix": crossmart.correlation_matrix(marts)}

    statement = """
        WITH d AS (SELECT obs_month, usdthb, real_rate FROM gold.dashboard_monthly WHERE usdthb IS NOT NULL)
        SELECT year(obs_month) AS year, max(usdthb) AS highest, count(real_rate) AS months
        FROM d GROUP BY 1 ORDER BY 1;
    """
    return serving.guarded_gold_query(spark, statement, gold)


# --- text columns ---------------------------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, id, turn, text): all documents and conversations as they are, and statements made from events.

    The statements carry the values of their event; by event type they are
    plain, repeated, forbidden, doubled or fenced.
    """
    kind, user, value = F.col("event_type"), F.col("user_id").cast("string"), F.col("props")
    query = F.concat(F.lit("SELECT * FROM t WHERE user_id = "), user)
    statement = (
        F.when(kind == "view", query)
        .when(kind == "signup", F.concat(F.lit("\twith x as ("), query, F.lit(") select * from x;; \n")))
        .when(kind == "purchase", F.concat(F.lit("select 1 from t where p = '"), value, F.lit("' -- drop table t")))
        .when(kind == "error", F.concat(query, F.lit("; SELECT "), user))
        .otherwise(F.concat(F.lit("```SQL\n"), query, F.lit(" /* — "), value, F.lit(" */\n```")))
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text"
    )
    conversations = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("source"), F.col("conv_id").alias("id"), "turn", "text"
    )
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.lit(0).cast("bigint").alias("turn"),
        statement.alias("text"),
    )
    return documents.unionByName(conversations).unionByName(events)


_TEXTS = """
texts AS (
  SELECT 'documents' AS source, doc_id AS id, CAST(0 AS BIGINT) AS turn, text FROM documents
  UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations
  UNION ALL
  SELECT 'events', event_id, 0, CASE event_type
    WHEN 'view' THEN q
    WHEN 'signup' THEN chr(9) || 'with x as (' || q || ') select * from x;; ' || chr(10)
    WHEN 'purchase' THEN 'select 1 from t where p = ''' || props || ''' -- drop table t'
    WHEN 'error' THEN q || '; SELECT ' || user_id
    ELSE '```SQL' || chr(10) || q || ' /* — ' || props || ' */' || chr(10) || '```' END
  FROM (SELECT *, 'SELECT * FROM t WHERE user_id = ' || user_id AS q FROM events)
)"""
_SPACES = " || ".join(f"chr({ord(c)})" for c in text.WHITESPACE)


@check(
    "screen_statements",
    rf"""WITH {_TEXTS},
    bodies AS (SELECT source, id, turn, rtrim(trim(text, {_SPACES}), ';') AS body FROM texts)
    SELECT source, id, turn, NOT contains(body, ';') AND regexp_matches(body, '(?i)^(select|with)([^\p{{L}}\p{{N}}_]|$)')
      AND NOT regexp_matches(body,
        '(?i)(^|[^\p{{L}}\p{{N}}_])(insert|update|delete|drop|alter|create|truncate|grant|revoke|copy|call)([^\p{{L}}\p{{N}}_]|$)')
      AS safe
    FROM bodies""",
)
def screen_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("source", "id", "turn", text.is_safe_select("text").alias("safe"))


@check(
    "strip_code_fence",
    rf"""WITH {_TEXTS}
    SELECT source, id, turn,
           trim(regexp_replace(trim(text, {_SPACES}), '(?im)^```sql[' || {_SPACES} || ']*|```$', '', 'g'), {_SPACES}) AS text
    FROM texts""",
)
def strip_code_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).withColumn("text", text.strip_code_fence("text"))


@check(
    "clean_reply_text",
    f"WITH {_TEXTS} SELECT source, id, turn, replace(trim(text, {_SPACES}), '—', ',') AS text FROM texts",
)
def clean_reply_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).withColumn("text", text.clean_reply_text("text"))
