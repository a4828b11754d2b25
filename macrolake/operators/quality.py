"""Data-quality gates: all rules of a suite in one aggregation, then one report.

A report has one row per rule (and per group): suite, rule, column_name,
n_rows, n_failed, passed. Ranges include both ends. A null or NaN is counted
by the not-null rule only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StructType

from macrolake.functions.dates import as_date
from macrolake.session import shared_dir


class DataQualityError(Exception):
    """At least one rule failed; names the first failed report rows, their total and the folder that holds all of them."""

    def __init__(self, failures: list, total: int, path: str) -> None:
        self.failures, self.total, self.path = failures, total, path
        lines = [f"{r['suite']}.{r['rule']}({r['column_name'] or '*'}): {r['n_failed']} failed" for r in failures]
        super().__init__("; ".join(lines) + f" ({total} in all, listed in {path})")


@dataclass(frozen=True)
class Rule:
    """A rule and the aggregate that counts its failures under a given schema."""

    name: str
    column: str | None
    failures: Callable[[StructType], Column]
    #: Failures of an expected group that has no rows.
    when_absent: int = 0


def _missing(schema: StructType, column: str) -> Column:
    value = F.col(column)
    floating = schema[column].dataType.typeName() in ("double", "float")
    return value.isNull() | F.isnan(value) if floating else value.isNull()


def _row_rule(name: str, column: str, bad: Callable[[Column], Column], when: Column | None = None) -> Rule:
    """Counts present values that are bad, among the rows that satisfy ``when``."""

    def failures(schema: StructType) -> Column:
        failed = ~_missing(schema, column) & bad(F.col(column))
        return F.count_if(failed if when is None else when & failed)

    return Rule(name, column, failures)


def in_range(column: str, low: float, high: float, when: Column | None = None) -> Rule:
    name = "in_range" if when is None else "conditional_range"
    return _row_rule(name, column, lambda c: ~c.between(low, high), when)


def non_negative(column: str) -> Rule:
    return _row_rule("non_negative", column, lambda c: c < 0)


def positive(column: str) -> Rule:
    return _row_rule("positive", column, lambda c: c <= 0)


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda schema: F.count_if(_missing(schema, column)))


def has_type(column: str, dtype: DataType) -> Rule:
    """Checks the schema only; the verdict joins the report as a constant."""

    def failures(schema: StructType) -> Column:
        ok = column in schema.names and schema[column].dataType == dtype
        return F.lit(0 if ok else 1).cast("bigint")

    return Rule("has_type", column, failures)


def min_rows(n: int) -> Rule:
    """Fails by the number of rows that are missing."""
    return Rule("min_rows", None, lambda _: F.greatest(F.lit(n) - F.count("*"), F.lit(0)), max(n, 0))


def exact_rows(n: int) -> Rule:
    return Rule("exact_rows", None, lambda _: F.abs(F.count("*") - F.lit(n)), abs(n))


def fresh(column: str, as_of: str | dt.date | Column, max_days: int) -> Rule:
    """Fails by the number of days beyond ``max_days``; no date at all counts as one."""

    def failures(_: StructType) -> Column:
        late = F.date_diff(as_date(as_of), F.max(column)) - F.lit(max_days)
        return F.when(F.max(column).isNull(), 1).otherwise(F.greatest(late, F.lit(0))).cast("bigint")

    return Rule("fresh", column, failures, 1)


def min_distinct(column: str, n: int) -> Rule:
    """Fails by the number of distinct values that are missing."""
    return Rule("min_distinct", column, lambda _: F.greatest(F.lit(n) - F.count_distinct(column), F.lit(0)), max(n, 0))


def band_order(low: str, middle: str, high: str) -> Rule:
    """low <= middle <= high; a null in any of them is a failure."""
    ordered = (F.col(low) <= F.col(middle)) & (F.col(middle) <= F.col(high))
    return Rule("band_order", middle, lambda _: F.count_if(~F.coalesce(ordered, F.lit(False))))


def within_factor(column: str, reference: str, factor: float) -> Rule:
    """column within [reference / factor, reference * factor]; a null counts as a failure."""
    inside = F.col(column).between(F.col(reference) / factor, F.col(reference) * factor)
    return Rule("within_factor", column, lambda _: F.count_if(~F.coalesce(inside, F.lit(False))))


def dq_report(df: DataFrame, suite: str, rules: list[Rule], by: list[str] | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Evaluate all rules in one pass; with ``by``, one set of report rows per group.

    A rule on a column that does not exist is reported as failed, with an
    unknown number of failures. ``expected`` lists the groups there must be
    (its columns ``by``; others and repeats do not matter): one without rows is
    reported with ``n_rows`` 0, and rules that ask for rows, distinct values or
    freshness fail on it. Groups that were not expected are reported too.
    """
    by = by or []
    rules = [*rules]
    absent = [r.column is not None and r.column not in df.columns and r.name != "has_type" for r in rules]
    counts = [F.lit(None).cast("bigint") if gone else r.failures(df.schema) for r, gone in zip(rules, absent)]
    totals = df.groupBy(*by).agg(
        F.count("*").alias("_rows"), *[c.cast("bigint").alias(f"_f{i}") for i, c in enumerate(counts)]
    )
    if expected is not None:
        totals = _with_absent_groups(totals, df.schema, rules, absent, by, expected)
    lines = [
        F.struct(
            F.lit(suite).alias("suite"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_f{i}").alias("n_failed"),
            F.coalesce(F.col(f"_f{i}") == 0, F.lit(False)).alias("passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return totals.select(*by, F.inline(F.array(*lines)))


def _with_absent_groups(
    totals: DataFrame, schema: StructType, rules: list[Rule], absent: list[bool], by: list[str], expected: DataFrame
) -> DataFrame:
    """The totals of the groups, and those of expected groups without rows; null-safe, as grouping is."""
    wanted = expected.select(*[F.col(c).alias(f"_want_{c}") for c in by]).distinct().withColumn("_wanted", F.lit(True))
    same = F.lit(True)
    for c in by:
        same = same & totals[c].eqNullSafe(F.col(f"_want_{c}"))
    joined = totals.withColumn("_there", F.lit(True)).join(wanted, same, "full_outer")
    there = F.col("_there").isNotNull()

    def empty(rule: Rule, gone: bool) -> Column:
        if gone:
            return F.lit(None).cast("bigint")
        return rule.failures(schema) if rule.name == "has_type" else F.lit(rule.when_absent).cast("bigint")

    return joined.select(
        *[F.when(there, F.col(c)).otherwise(F.col(f"_want_{c}")).alias(c) for c in by],
        F.coalesce("_rows", F.lit(0)).cast("bigint").alias("_rows"),
        *[F.when(there, F.col(f"_f{i}")).otherwise(empty(r, gone)).alias(f"_f{i}") for i, (r, gone) in enumerate(zip(rules, absent))],
    )


def month_gaps(rows: DataFrame, by: list[str], month: str = "obs_month") -> DataFrame:
    """The months missing between the first and last of each series: (by, gap_from, gap_to, n_months), one row for each gap.

    Rows are reduced to months before the window, so a series meets as at
    most its calendar months. Null months do not count.
    """
    months = rows.filter(F.col(month).isNotNull()).select(*by, F.trunc(month, "month").alias("_month")).distinct()
    following = F.lead("_month").over(Window.partitionBy(*by).orderBy("_month"))
    return (
        months.withColumn("_next", following)
        .filter(F.col("_next") > F.add_months("_month", 1))
        .select(
            *by,
            F.add_months("_month", 1).alias("gap_from"),
            F.add_months("_next", -1).alias("gap_to"),
            (F.months_between("_next", "_month") - 1).cast("int").alias("n_months"),
        )
    )


def dq_enforce(report: DataFrame, shown: int = 100, path: str | None = None) -> None:
    """Raise if any rule failed. Run it before the write, so that a failed gate leaves the mart as it was.

    Every rule is evaluated and every failure is written to ``path``, by
    default a fresh folder of the shared location; ``shown`` only limits the
    failures that the message names.
    """
    failed = report.filter(~F.col("passed"))
    if failed.isEmpty():
        return
    path = path or shared_dir(report.sparkSession)
    failed.write.parquet(path)
    stored = report.sparkSession.read.schema(failed.schema).parquet(path)
    raise DataQualityError(stored.limit(shown).collect(), stored.count(), path)


def with_last_actual(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Add the last actual value of each indicator as ``last_value``.

    The actuals are reduced to one row per indicator before the join.
    """
    last = actuals.groupBy("indicator").agg(F.max_by("value", "obs_month").alias("last_value"))
    return forecasts.join(last, "indicator", "left")


# The limits of the suites.


def set_suite(as_of: str | dt.date | Column) -> list[Rule]:
    """Wide (obs_date, set_index, set_volume)."""
    return [
        has_type("set_index", DoubleType()),
        has_type("set_volume", DoubleType()),
        not_null("set_index"),
        not_null("set_volume"),
        in_range("set_index", 50, 5000),
        non_negative("set_volume"),
        min_rows(100),
        fresh("obs_date", as_of, 7),
    ]


def set_long_suite(as_of: str | dt.date | Column) -> list[Rule]:
    """Long (indicator_code, obs_date, value)."""
    return [
        min_distinct("obs_date", 100),
        not_null("value"),
        in_range("value", 50, 5000, when=F.col("indicator_code") == "TH.SET_INDEX"),
        non_negative("value"),
        fresh("obs_date", as_of, 7),
    ]


def fx_suite(as_of: str | dt.date | Column) -> list[Rule]:
    """(obs_date, usdthb)."""
    return [
        has_type("usdthb", DoubleType()),
        not_null("usdthb"),
        in_range("usdthb", 18, 60),
        min_rows(100),
        fresh("obs_date", as_of, 14),
    ]


def _level_suite(column: str, low: float, high: float, rows: int) -> list[Rule]:
    """Sources that publish late or only on events: no freshness rule."""
    return [has_type(column, DoubleType()), not_null(column), in_range(column, low, high), min_rows(rows)]


def policy_rate_suite() -> list[Rule]:
    return _level_suite("policy_rate", 0, 12, 100)


def cpi_suite() -> list[Rule]:
    return _level_suite("cpi_yoy", -8, 50, 100)


def bond_suite() -> list[Rule]:
    return _level_suite("bond_10y", 0, 15, 12)


def forecast_suite(periods: int | None = None) -> list[Rule]:
    """Forecast rows (yhat, yhat_lower, yhat_upper); ``periods`` is the number of rows per report group."""
    columns = ("yhat", "yhat_lower", "yhat_upper")
    rules = [has_type(c, DoubleType()) for c in columns] + [not_null(c) for c in columns]
    rules += [positive("yhat"), band_order("yhat_lower", "yhat", "yhat_upper")]
    return rules if periods is None else [*rules, exact_rows(periods)]


def forecast_sanity_suite() -> list[Rule]:
    """Forecast rows with ``last_value``: positive, within a third and three times of it, inside the band."""
    return [
        positive("yhat"),
        within_factor("yhat", "last_value", 3),
        band_order("yhat_lower", "yhat", "yhat_upper"),
    ]
