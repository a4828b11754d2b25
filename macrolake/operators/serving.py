"""Read queries over the gold layer.

Gold has one row per calendar month (and indicator), so windows over the months
of a mart or of an indicator are bounded by the calendar, not by the data.
Results of any size (:func:`preview_with_total`) are counted while they are cut.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from macrolake.functions.dates import as_date, month_bucket
from macrolake.functions.text import is_safe_select

#: Metrics of the headline figures, each with its monthly change where the mart has one.
HEADLINE_METRICS = {"set_close": "set_mom", "usdthb": "usdthb_mom", "policy_rate": None, "cpi_yoy": None}


def gold_dashboard(dashboard: DataFrame) -> DataFrame:
    """The whole dashboard in month order."""
    return dashboard.orderBy("obs_month")


def gold_forecast(forecast: DataFrame, indicator: str) -> DataFrame:
    """Actual and forecast rows of one indicator in month order."""
    return (
        forecast.filter(F.col("indicator") == indicator)
        .select("obs_month", "yhat", "yhat_lower", "yhat_upper", "is_forecast")
        .orderBy("obs_month", "is_forecast")
    )


def latest_n_rows(dashboard: DataFrame, n: int = 3) -> DataFrame:
    """The latest ``n`` months, newest first."""
    return dashboard.orderBy(F.col("obs_month").desc()).limit(n)


def _all_months():
    """Every row of a frame that has one row per calendar month; never use it on more than that."""
    return Window.partitionBy()


def month_range(dashboard: DataFrame, lo: str | dt.date | Column, hi: str | dt.date | Column) -> DataFrame:
    """The months between two chosen months.

    A bound that is no present month snaps to the latest present month before
    it, or to the first month. The end is chosen first and the start may not
    pass it. The bounds are found in the same pass as the rows, so the
    dashboard is evaluated once.
    """
    month = F.col("obs_month")

    def snap(bound: str | dt.date | Column) -> Column:
        before = F.when(month <= month_bucket(as_date(bound)), month)
        return F.coalesce(F.max(before).over(_all_months()), F.min(month).over(_all_months()))

    return (
        dashboard.withColumns({"_lo": snap(lo), "_hi": snap(hi)})
        .filter(month.between(F.least("_lo", "_hi"), F.col("_hi")))
        .drop("_lo", "_hi")
    )


def latest_stats(dashboard: DataFrame) -> DataFrame:
    """Per headline metric: its last non-null value, that month, the change in that same row and its sign.

    A metric without a value has a row of nulls.
    """
    picks = [
        f"""max_by(named_struct('obs_month', obs_month, 'value', {metric},
            'mom', {change or "cast(null as double)"}), if({metric} is null, null, obs_month)) as {metric}"""
        for metric, change in HEADLINE_METRICS.items()
    ]
    lines = [f"named_struct('metric', '{m}', 'obs_month', {m}.obs_month, 'value', {m}.value, 'mom', {m}.mom)" for m in HEADLINE_METRICS]
    direction = F.expr("case when mom >= 0 then 'up' when mom < 0 then 'down' end")
    return (
        dashboard.agg(*[F.expr(pick) for pick in picks])
        .select(F.expr(f"inline(array({', '.join(lines)}))"))
        .withColumn("direction", direction)
    )


def trim_null_edges(dashboard: DataFrame, metric: str) -> DataFrame:
    """(obs_month, metric) from the first to the last non-null month, inner nulls kept."""
    present = F.when(F.col(metric).isNotNull(), F.col("obs_month"))
    edges = {"_first": F.min(present).over(_all_months()), "_last": F.max(present).over(_all_months())}
    return (
        dashboard.select("obs_month", metric)
        .withColumns(edges)
        .filter(F.col("obs_month").between(F.col("_first"), F.col("_last")))
        .drop("_first", "_last")
    )


def _month_order():
    return Window.partitionBy("indicator").orderBy("obs_month", "is_forecast")


def _whole_series():
    return _month_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def forecast_window(forecast: DataFrame, history: int = 12) -> DataFrame:
    """Per indicator: the last ``history`` rows before the first forecast, and everything after.

    A series without a forecast, or that starts with one, is returned whole.
    """
    position = F.row_number().over(_month_order())
    first = F.min(F.when(F.col("is_forecast"), F.col("_position"))).over(_whole_series())
    return (
        forecast.withColumn("_position", position)
        .withColumn("_first", first)
        .filter(F.col("_first").isNull() | (F.col("_position") >= F.col("_first") - history))
        .drop("_position", "_first")
    )


def forecast_plot_series(forecast: DataFrame) -> DataFrame:
    """Per indicator the plotted columns actual, forecast, upper and lower.

    The last actual point is repeated in the forecast columns so that the
    lines meet.
    """
    position = F.row_number().over(_month_order())
    last_actual = F.max(F.when(~F.col("is_forecast"), F.col("_position"))).over(_whole_series())
    meets = F.col("_position") == F.col("_last_actual")

    def ahead(column: str) -> Column:
        return F.when(F.col("is_forecast"), F.col(column)).when(meets, F.col("yhat"))

    return (
        forecast.withColumn("_position", position)
        .withColumn("_last_actual", last_actual)
        .select(
            "indicator",
            "obs_month",
            F.when(~F.col("is_forecast"), F.col("yhat")).alias("actual"),
            ahead("yhat").alias("forecast"),
            ahead("yhat_upper").alias("upper"),
            ahead("yhat_lower").alias("lower"),
        )
    )


def extreme_month(dashboard: DataFrame, metric: str, year: int | None = None, highest: bool = True) -> DataFrame:
    """The month with the largest (or smallest) value of a metric per year, nulls excluded.

    The earliest month wins a tie. ``year`` restricts the answer to one year.
    """
    value, month = F.col(metric), F.col("obs_month")
    rows = dashboard.filter(value.isNotNull())
    if year is not None:
        rows = rows.filter(month.between(as_date(f"{year}-01-01"), as_date(f"{year}-12-31")))
    # Earlier months sort higher, so a single maximum settles value and tie.
    rank = F.struct(value if highest else -value, -F.unix_date(month))
    return rows.groupBy(F.year(month).alias("year")).agg(
        F.max_by(month, rank).alias("obs_month"), F.max_by(value, rank).alias(metric)
    )


def preview_with_total(result: DataFrame, order: list[str], n: int = 12) -> DataFrame:
    """The first ``n`` rows in a given order, each with the total row count.

    One pass: the rows are counted as they flow into the top-k, whose ``n``
    rows are all that leaves the cluster. The order is given as one struct,
    because a result known to be sorted by its columns would be cut before it is
    counted.
    """
    seen = Observation()
    counted = result.observe(seen, F.count(F.lit(1)).alias("n"))
    rows = counted.orderBy(F.struct(*order)).limit(n).collect()
    first = result.sparkSession.createDataFrame(rows, result.schema)
    return first.orderBy(*order).withColumn("total_rows", F.lit(seen.get["n"]).cast("bigint"))


def actual_vs_forecast(forecast: DataFrame, is_forecast: bool) -> DataFrame:
    """Only the actual or only the forecast rows."""
    flag = F.col("is_forecast")
    return forecast.filter(flag if is_forecast else ~flag)


class UnsafeStatement(ValueError):
    """The text is not one read-only SELECT over the gold views."""


# The operators an answer may be made of; relations other than the gold views are none of them.
_OPERATORS = frozenset(
    "Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset Distinct Deduplicate Union Intersect Except Window Expand Generate "
    "LateralJoin Subquery SubqueryAlias WithCTE CTERelationDef CTERelationRef OneRowRelation ResolvedHint".split()
)
# Expressions that run code of the class path or a worker, or tell where files lie.
_FORBIDDEN = frozenset("CallMethodViaReflection ScalaUDF PythonUDF PythonUDAF PythonUDTF InputFileName".split())


def isolated_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with the same settings, and without the caller's temp views, functions and database."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def guarded_gold_query(spark: SparkSession, statement: str, relations: Callable[[SparkSession], dict[str, DataFrame]]) -> DataFrame:
    """Run a SELECT over the named gold views after the statement screen.

    ``relations`` builds the views in the session it is given, which is a
    fresh one: nothing of the caller's is seen or replaced. Views may be
    written as ``gold.<name>`` or ``<name>``. The decision is made on the
    analysed plan, before anything runs: all its leaves must be gold views, it
    may hold no command, no operator beyond those of queries, no function that
    runs other code. Other text is rejected. The answer belongs to the fresh session.
    """
    safe = spark.range(1).select(is_safe_select(F.lit(statement)).alias("safe")).first()["safe"]
    if not safe:
        raise UnsafeStatement(statement)
    session = isolated_session(spark)
    views = relations(session)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    body = _unqualified(statement.strip().rstrip(";"), views)
    if _holds_command(session, body):
        raise UnsafeStatement(statement)
    try:
        answer = session.sql(body)
    except AnalysisException as error:
        if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY"):
            raise UnsafeStatement(f"{statement}: relation not found in gold") from error
        raise
    if reason := _not_gold(session, answer, views):
        raise UnsafeStatement(f"{statement}: {reason}")
    return answer


def _holds_command(session: SparkSession, text: str) -> bool:
    """Whether the parsed text would do something rather than ask."""
    command = session._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    nodes = [session._jsparkSession.sessionState().sqlParser().parsePlan(text)]
    while nodes:
        node = nodes.pop()
        if command.isInstance(node):
            return True
        nodes += _listed(node.children())
    return False


def _not_gold(session: SparkSession, answer: DataFrame, views: dict[str, DataFrame]) -> str | None:
    """What in the analysed plan is neither a gold view nor a plain operator or expression over them; None if all is well."""
    subquery = session._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression")
    nodes = [answer._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "View":
            name = node.desc().identifier()
            if node.isTempView() and name.database().isEmpty() and name.table().lower() in views:
                continue  # what a gold view is made of is not the asker's
            return f"{name.unquotedString()} is not in gold"
        if kind not in _OPERATORS:
            return f"{kind} is not allowed"
        nodes += _listed(node.children())
        expressions = _listed(node.expressions())
        while expressions:
            expression = expressions.pop()
            full = expression.getClass().getName()
            if not full.startswith("org.apache.spark.sql.catalyst.") or full.rsplit(".", 1)[-1] in _FORBIDDEN:
                return f"{expression.prettyName()} is not allowed"
            if subquery.isInstance(expression):
                nodes.append(expression.plan())
            expressions += _listed(expression.children())
    return None


def _listed(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _unqualified(statement: str, views: dict[str, DataFrame]) -> str:
    """Drop the ``gold.`` in front of view names, outside of quoted text and comments."""
    qualified = re.compile(rf"(?<![\w.`])(?:gold|`gold`)\s*\.\s*(`?)({'|'.join(map(re.escape, views))})\1(?![\w`])", re.IGNORECASE)
    quoted = r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|--[^\n]*|/\*.*?\*/)"""
    pieces = re.split(quoted, statement, flags=re.DOTALL)
    return "".join(p if i % 2 else qualified.sub(r"\2", p) for i, p in enumerate(pieces))
