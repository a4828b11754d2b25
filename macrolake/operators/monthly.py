"""Monthly marts: period aggregates, month-on-month change, calendar spine, as-of values.

Inputs are silver rows (indicator_code, obs_date, value) with unique keys.
``keys`` are the columns of one series; an empty list means the input is one
series. Windows run only after the reduction to months, so what meets in one
task is at most the number of calendar months of one series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrolake.functions.dates import as_date, month_bucket, month_series
from macrolake.functions.stats import exact_avg, exact_sum, exponent_class, sum_classes, with_total
from macrolake.operators.silver import select_series

SERIES = ["indicator_code"]


def _by_month(rows: DataFrame, keys: list[str]):
    return rows.groupBy(*keys, month_bucket("obs_date").alias("obs_month"))


def _in_month_order(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("obs_month")


def period_last(rows: DataFrame, keys: list[str] = SERIES, name: str = "value") -> DataFrame:
    """The value of the last observation of each month, null if that observation is null."""
    return _by_month(rows, keys).agg(F.max_by("value", "obs_date").alias(name))


def monthly_facts(rows: DataFrame, keys: list[str] = SERIES, scale: int | None = None) -> DataFrame:
    """What the marts need of each month of a series: ``last`` observation, ``sum`` and ``avg`` of the values.

    Sums do not depend on the order of the rows. With ``scale`` the values are
    added as decimals of that many places. Without it they are added by classes of
    their exponent, a month's classes are joined and rounded once: the sum is the
    double nearest to the exact one.
    """
    if scale is not None:
        return _by_month(rows, keys).agg(
            F.max_by("value", "obs_date").alias("last"), exact_sum("value", scale).alias("sum"), exact_avg("value", scale).alias("avg")
        )
    month = month_bucket("obs_date").alias("obs_month")
    classed = rows.select(*keys, "obs_date", "value", month).withColumn("_class", exponent_class("value"))
    parts = classed.groupBy(*keys, "obs_month", "_class").agg(
        F.max_by("value", "obs_date").alias("_last"),
        F.max("obs_date").alias("_last_date"),
        F.count("value").alias("_n"),
        *[c.alias(name) for name, c in sum_classes("value", "_class").items()],
    )
    # One row for each class of a month: a few, however many observations it has.
    months = parts.groupBy(*keys, "obs_month").agg(
        F.max_by("_last", "_last_date").alias("last"),
        F.sum("_n").alias("_n"),
        F.sum("_special").alias("_special"),
        F.expr("collect_list(CASE WHEN _class >= 0 THEN named_struct('class', _class, 'limb0', _limb0, 'limb1', _limb1, 'limb2', _limb2) END)").alias("_classes"),
    )
    return with_total(months, "_classes", "_special", "sum").select(
        *keys, "obs_month", "last", "sum", F.try_divide("sum", "_n").alias("avg")
    )


def period_sum(
    rows: DataFrame, keys: list[str] = SERIES, name: str = "value", scale: int | None = None
) -> DataFrame:
    """The sum of each month, exact as in :func:`monthly_facts`."""
    return monthly_facts(rows, keys, scale).select(*keys, "obs_month", F.col("sum").alias(name))


def period_avg(
    rows: DataFrame, keys: list[str] = SERIES, name: str = "value", scale: int | None = None
) -> DataFrame:
    """The mean of each month, its exact sum over its number of values."""
    return monthly_facts(rows, keys, scale).select(*keys, "obs_month", F.col("avg").alias(name))


def pct_change(column: str, keys: list[str]) -> Column:
    """100 * (x / previous x - 1) against the previous month that is present."""
    return 100 * (F.col(column) / F.lag(column).over(_in_month_order(keys)) - 1)


def mom_pct(monthly: DataFrame, column: str, name: str, keys: list[str] = SERIES) -> DataFrame:
    """Add the month-on-month change of ``column``; null in the first month, an error on a zero divisor."""
    return monthly.withColumn(name, pct_change(column, keys))


def set_monthly(
    silver: DataFrame,
    index_code: str = "TH.SET_INDEX",
    volume_code: str = "TH.SET_VOLUME",
    scale: int | None = None,
) -> DataFrame:
    """Last index value, summed volume and index change per month.

    Months without an index value are left out; months without volume keep a
    null volume. Both series come out of one aggregate instead of two
    aggregates and a join. Without ``scale`` the volumes are added as in
    :func:`monthly_facts`.
    """
    is_index = F.col("indicator_code") == index_code
    rows = select_series(silver, index_code, volume_code)
    if scale is None:
        last, volume = F.max(F.when(is_index, F.col("last"))), F.max(F.when(~is_index, F.col("sum")))
        months = monthly_facts(rows).groupBy("obs_month")
    else:
        last, volume = F.max_by("value", F.when(is_index, F.col("obs_date"))), exact_sum(F.when(~is_index, F.col("value")), scale)
        months = _by_month(rows, [])
    present = months.agg(last.alias("set_close"), volume.alias("set_volume"), F.count_if(is_index).alias("_days")).filter("_days > 0")
    return mom_pct(present.drop("_days"), "set_close", "set_mom", [])


def fx_monthly(silver: DataFrame, code: str = "FX.USDTHB") -> DataFrame:
    """Last rate and its change per month."""
    months = period_last(select_series(silver, code), [], "usdthb")
    return mom_pct(months, "usdthb", "usdthb_mom", [])


def cpi_monthly(silver: DataFrame, code: str = "TH.CPI_YOY", scale: int | None = None) -> DataFrame:
    """Mean inflation rate per month."""
    return period_avg(select_series(silver, code), [], "cpi_yoy", scale)


def bond_monthly(silver: DataFrame, code: str = "TH.BOND_10Y", scale: int | None = None) -> DataFrame:
    """Mean bond yield per month."""
    return period_avg(select_series(silver, code), [], "bond_10y", scale)


def series_bounds(rows: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """First and last observation date of each series."""
    return rows.groupBy(*keys).agg(
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date")
    )


def month_spine(rows: DataFrame, as_of: str | dt.date | Column, keys: list[str] = SERIES) -> DataFrame:
    """Every month from the first observation of a series to the month of ``as_of``."""
    months = month_series(month_bucket("first_date"), month_bucket(as_date(as_of)))
    bounds = rows.groupBy(*keys).agg(F.min("obs_date").alias("first_date"))
    return bounds.select(*keys, F.explode(months).alias("obs_month"))


def asof_month_end(
    rows: DataFrame, as_of: str | dt.date | Column, keys: list[str] = SERIES, name: str = "value"
) -> DataFrame:
    """For each month up to ``as_of`` the value of the latest observation up to its last day.

    Each observed month is repeated until the month before the next observed
    one. That yields the calendar spine by itself: no join of months with
    observations, equi or not. A latest observation that is null stays null.
    Later observations are dropped by a plain date bound, which reaches the scan.
    """
    known = rows.filter(F.col("obs_date") <= F.last_day(as_date(as_of)))
    return carry_forward(period_last(known, keys, name), as_of, keys, name)


def carry_forward(
    monthly: DataFrame, as_of: str | dt.date | Column, keys: list[str] = SERIES, name: str = "value"
) -> DataFrame:
    """Fill the gaps of monthly last values with the value before, up to the month of ``as_of``."""
    end = month_bucket(as_date(as_of))
    following = F.lead("obs_month").over(_in_month_order(keys))
    until = F.coalesce(F.add_months(following, -1), end)
    return (
        monthly.filter(F.col("obs_month") <= end)
        .withColumn("_until", until)
        .select(*keys, F.explode(month_series(F.col("obs_month"), F.col("_until"))).alias("obs_month"), name)
    )


def policy_rate_monthly(
    silver: DataFrame, as_of: str | dt.date | Column, code: str = "TH.POLICY_RATE"
) -> DataFrame:
    """The policy rate in force at each month end, from the first observed month on."""
    return asof_month_end(select_series(silver, code), as_of, [], "policy_rate")
