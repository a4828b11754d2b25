"""Incremental refresh: which months a batch touches, and which months of the dashboard change with them.

Silver is large, the facts of its months are few. So only the touched months of
the touched series are read from silver again; what follows from them, changes
and carried-forward rates included, is worked out on the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrolake.functions.dates import as_date, month_bucket, month_series
from macrolake.operators.crossmart import dashboard_from_facts
from macrolake.operators.monthly import SERIES, _in_month_order, monthly_facts

MONTH = [*SERIES, "obs_month"]


def touched_months(changed: DataFrame) -> DataFrame:
    """(indicator_code, obs_month) of the rows that a batch inserted or changed."""
    return changed.select(*SERIES, month_bucket("obs_date").alias("obs_month")).distinct()


def refreshed_facts(stored: DataFrame, silver: DataFrame, touched: DataFrame, scale: int | None = None) -> DataFrame:
    """The stored facts with those of the touched months computed anew from silver."""
    rows = silver.withColumn("obs_month", month_bucket("obs_date")).join(touched, MONTH, "left_semi")
    fresh = monthly_facts(rows.drop("obs_month"), SERIES, scale)
    return stored.join(touched, MONTH, "left_anti").unionByName(fresh)


def affected_months(
    facts: DataFrame,
    touched: DataFrame,
    as_of: str | dt.date | Column,
    before: str | dt.date | Column | None = None,
    changing: tuple[str, ...] = ("TH.SET_INDEX", "FX.USDTHB"),
    carried: tuple[str, ...] = ("TH.POLICY_RATE",),
) -> DataFrame:
    """The months (obs_month) whose dashboard row a batch can change.

    That is each touched month; for a series with a change also its next present
    month, which refers back to it; for a series carried forward the months
    up to its next present one, or to ``as_of``. ``before`` is the day of the
    last refresh: months between the two days gain or lose carried values.
    """
    end = month_bucket(as_date(as_of))
    code, month = F.col("indicator_code"), F.col("obs_month")
    following = facts.select(*MONTH, F.lead("obs_month").over(_in_month_order(SERIES)).alias("following"))
    carried_on = F.when(code.isin(*carried) & (month <= end), F.coalesce(F.add_months("following", -1), end))
    months = (
        following.join(touched, MONTH, "left_semi")
        .select("obs_month", F.when(code.isin(*changing), F.col("following")).alias("next"), F.coalesce(F.greatest(carried_on, month), month).alias("until"))
        .select(F.explode(F.concat(month_series(F.col("obs_month"), F.col("until")), F.array_compact(F.array("next")))).alias("obs_month"))
    )
    if before is not None:
        old = month_bucket(as_date(before))
        between = F.when(old != end, month_series(F.add_months(F.least(old, end), 1), F.greatest(old, end)))
        months = months.union(facts.sparkSession.range(1).select(F.explode(between).alias("obs_month")))
    return months.distinct()


def refreshed_dashboard(stored: DataFrame, facts: DataFrame, affected: DataFrame, as_of: str | dt.date | Column, **codes: str) -> DataFrame:
    """The stored dashboard with the affected months replaced; months that no series has any more are gone."""
    fresh = dashboard_from_facts(facts, as_of, **codes).join(affected, "obs_month", "left_semi")
    return stored.join(affected, "obs_month", "left_anti").unionByName(fresh)
