"""Views over the monthly marts: dashboard, real rate, correlation matrix."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrolake.functions.dates import as_date, month_bucket, month_series
from macrolake.functions.stats import paired_corr, paired_count
from macrolake.operators.monthly import SERIES, _in_month_order, monthly_facts, pct_change

DASHBOARD_COLUMNS = [
    "obs_month", "set_close", "set_mom", "set_volume", "usdthb", "usdthb_mom",
    "policy_rate", "cpi_yoy", "bond_10y", "real_rate",
]

#: Series compared over the months where all of them are present.
COMPLETE_CASE = ["set_mom", "usdthb_mom", "policy_rate", "cpi_yoy"]
#: Pairs compared over their own common months, because the bond series is short.
PAIRWISE = [("bond_10y", "policy_rate"), ("bond_10y", "cpi_yoy"), ("bond_10y", "usdthb_mom")]


def dashboard_monthly(
    set_m: DataFrame, fx_m: DataFrame, policy_m: DataFrame, cpi_m: DataFrame, bond_m: DataFrame
) -> DataFrame:
    """Full join of the stored marts on obs_month, plus the real rate.

    obs_month is unique in every mart, so the five-way full join is a union
    followed by one aggregate per month: one shuffle instead of five.
    """
    marts = set_m
    for mart in (fx_m, policy_m, cpi_m, bond_m):
        marts = marts.unionByName(mart, allowMissingColumns=True)
    values = [c for c in DASHBOARD_COLUMNS if c not in ("obs_month", "real_rate")]
    return _with_real_rate(marts.groupBy("obs_month").agg(*[F.max(c).alias(c) for c in values]))


def dashboard_from_silver(
    silver: DataFrame,
    as_of: str | dt.date | Column,
    set_index: str = "TH.SET_INDEX",
    set_volume: str = "TH.SET_VOLUME",
    fx: str = "FX.USDTHB",
    policy: str = "TH.POLICY_RATE",
    cpi: str = "TH.CPI_YOY",
    bond: str = "TH.BOND_10Y",
    scale: int | None = None,
) -> DataFrame:
    """The dashboard straight from silver, reading the observations once.

    One aggregate per (indicator, month) serves all six series; the rest is
    :func:`dashboard_from_facts` on its few rows.
    """
    codes = [set_index, set_volume, fx, policy, cpi, bond]
    facts = monthly_facts(silver.filter(F.col("indicator_code").isin(codes)), SERIES, scale)
    return dashboard_from_facts(facts, as_of, *codes)


def dashboard_from_facts(
    facts: DataFrame,
    as_of: str | dt.date | Column,
    set_index: str = "TH.SET_INDEX",
    set_volume: str = "TH.SET_VOLUME",
    fx: str = "FX.USDTHB",
    policy: str = "TH.POLICY_RATE",
    cpi: str = "TH.CPI_YOY",
    bond: str = "TH.BOND_10Y",
) -> DataFrame:
    """The dashboard from (indicator_code, obs_month, last, sum, avg), one row per series and month.

    Changes and the carried-forward policy rate are computed first, then a
    second aggregate turns indicators into columns.
    """
    end = month_bucket(as_date(as_of))
    code = F.col("indicator_code")
    monthly = facts.filter(code.isin([set_index, set_volume, fx, policy, cpi, bond])).filter((code != policy) | (F.col("obs_month") <= end))
    # The change is only taken for the two series that report one: a zero in
    # another series is not an error there.
    following = F.lead("obs_month").over(_in_month_order(SERIES))
    until = F.when(code == policy, F.coalesce(F.add_months(following, -1), end)).otherwise(F.col("obs_month"))
    per_series = monthly.select(
        "*",
        F.when(code.isin(set_index, fx), pct_change("last", SERIES)).alias("mom"),
        until.alias("until"),
    ).select(
        "indicator_code", "last", "sum", "avg", "mom",
        F.explode(month_series(F.col("obs_month"), F.col("until"))).alias("obs_month"),
    )

    def cell(series: str, column: str, name: str) -> Column:
        return F.max(F.when(code == series, F.col(column))).alias(name)

    return _with_real_rate(
        per_series.groupBy("obs_month")
        .agg(
            cell(set_index, "last", "set_close"),
            cell(set_index, "mom", "set_mom"),
            cell(set_volume, "sum", "_volume"),
            cell(fx, "last", "usdthb"),
            cell(fx, "mom", "usdthb_mom"),
            cell(policy, "last", "policy_rate"),
            cell(cpi, "avg", "cpi_yoy"),
            cell(bond, "avg", "bond_10y"),
            F.count_if(code == set_index).alias("_index"),
            F.count_if(code != set_volume).alias("_series"),
        )
        # Volume alone does not make a month: it joins the months of the index.
        .filter("_series > 0")
        .withColumn("set_volume", F.expr("if(_index > 0, _volume, null)"))
    )


def _with_real_rate(wide: DataFrame) -> DataFrame:
    return wide.withColumn("real_rate", F.col("policy_rate") - F.col("cpi_yoy")).select(*DASHBOARD_COLUMNS)


def real_rate_monthly(policy_m: DataFrame, cpi_m: DataFrame) -> DataFrame:
    """Policy rate minus inflation for the months that both marts have."""
    return policy_m.join(cpi_m, "obs_month", "inner").select(
        "obs_month", "policy_rate", "cpi_yoy", (F.col("policy_rate") - F.col("cpi_yoy")).alias("real_rate")
    )


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def corr_complete_case(dashboard: DataFrame) -> DataFrame:
    """The six pairs of the complete-case series, over the months where all four are present."""
    rows = dashboard.dropna(subset=COMPLETE_CASE)
    return _correlate(rows, _pairs(COMPLETE_CASE))


def corr_pairwise(dashboard: DataFrame) -> DataFrame:
    """The bond pairs, each over the months where both series are present."""
    return _correlate(dashboard, PAIRWISE)


def _correlate(rows: DataFrame, pairs: list[tuple[str, str]], prefix: str = "") -> DataFrame:
    """(var1, var2, correlation, n) of column pairs in one aggregate; ``prefix`` is not part of the names."""
    totals = rows.agg(
        *[paired_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        *[paired_count(a, b).alias(f"n{i}") for i, (a, b) in enumerate(pairs)],
    )
    lines = [
        f"named_struct('var1', '{a.removeprefix(prefix)}', 'var2', '{b.removeprefix(prefix)}', "
        f"'correlation', round(r{i}, 3), 'n', n{i})"
        for i, (a, b) in enumerate(pairs)
    ]
    return totals.selectExpr(f"inline(array({', '.join(lines)}))")


def correlation_matrix(dashboard: DataFrame) -> DataFrame:
    """All nine pairs as (var1, var2, correlation, n) from one pass over the dashboard.

    The complete-case rule becomes a mask on its four series, so both groups
    of pairs come out of the same aggregate. No months gives nine rows with a
    null correlation and n = 0.
    """
    complete = " and ".join(f"{c} is not null" for c in COMPLETE_CASE)
    masked = dashboard.selectExpr(
        "bond_10y", *COMPLETE_CASE, *[f"if({complete}, {c}, null) as complete_{c}" for c in COMPLETE_CASE]
    )
    pairs = [(f"complete_{a}", f"complete_{b}") for a, b in _pairs(COMPLETE_CASE)]
    return _correlate(masked, pairs + PAIRWISE, prefix="complete_")


def corr_ranked(matrix: DataFrame) -> DataFrame:
    """Strongest correlation first; nulls lead, ties go by name."""
    return matrix.orderBy(F.abs("correlation").desc_nulls_first(), "var1", "var2")
