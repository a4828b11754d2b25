"""The batch jobs of the lake: land -> bronze -> silver -> gate -> gold, the forecast and the dashboard refresh.

A job is its stages in order: ``<name>_to_bronze``, ``<name>_to_silver`` and
``<name>_to_gold``, which holds the gate, so one that fails leaves the mart as it
was. Stages pass state through stored tables only. A run has an id, which is the
name of its bronze folders; ids sort by time. Each stage may be run again by
itself: bronze replaces the folders of its run, silver reads the documents
that were the newest at that run and merges what is new in them, gold rebuilds.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from macrolake import catalog, schemas
from macrolake.catalog import Indicator
from macrolake.operators import bronze, crossmart, forecast, monthly, quality, refresh, serving, silver
from macrolake.session import shared_dir
from macrolake.sources import lake as tables
from macrolake.sources.landed import optional_source
from macrolake.sources.merge import BY_YEAR, kept, merge_by_year, with_year

log = logging.getLogger(__name__)

AsOf = str | dt.date

MART_SCHEMAS = {
    "set_monthly": schemas.SET_MONTHLY,
    "fx_monthly": schemas.FX_MONTHLY,
    "policy_rate_monthly": schemas.POLICY_RATE_MONTHLY,
    "cpi_monthly": schemas.CPI_MONTHLY,
    "bond_monthly": schemas.BOND_MONTHLY,
}


@dataclass(frozen=True)
class Lake:
    """Paths of the stored tables below one root."""

    spark: SparkSession
    root: str

    @property
    def raw_path(self) -> str:
        return f"{self.root}/bronze/raw_observation"

    @property
    def observation_path(self) -> str:
        return f"{self.root}/silver/macro_observation"

    @property
    def dim_path(self) -> str:
        return f"{self.root}/silver/indicator_dim"

    @property
    def forecast_path(self) -> str:
        return f"{self.root}/gold/forecast_monthly"

    @property
    def facts_path(self) -> str:
        return f"{self.root}/gold/monthly_facts"

    @property
    def dashboard_path(self) -> str:
        return f"{self.root}/gold/dashboard_monthly"

    @property
    def pending_path(self) -> str:
        return f"{self.root}/gold/pending_months"

    @property
    def refreshed_path(self) -> str:
        return f"{self.root}/gold/refreshed_until"

    def mart_path(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def raw(self) -> DataFrame:
        return self._stored(self.raw_path, schemas.RAW_OBSERVATION)

    def observations(self) -> DataFrame:
        return self.observations_by_year().select(*schemas.MACRO_OBSERVATION.names)

    def observations_by_year(self) -> DataFrame:
        return self._stored(self.observation_path, schemas.OBSERVATION_BY_YEAR)

    def dims(self) -> DataFrame:
        return self._stored(self.dim_path, schemas.INDICATOR_DIM)

    def mart(self, name: str) -> DataFrame:
        return self._stored(self.mart_path(name), MART_SCHEMAS[name])

    def forecasts(self) -> DataFrame:
        return self._stored(self.forecast_path, schemas.FORECAST_MONTHLY)

    def facts(self) -> DataFrame:
        return self._stored(self.facts_path, schemas.MONTHLY_FACTS)

    def dashboard(self) -> DataFrame:
        return self._stored(self.dashboard_path, schemas.DASHBOARD_MONTHLY)

    def pending(self) -> DataFrame:
        return self._stored(self.pending_path, schemas.PENDING_MONTHS)

    def refreshed_until(self) -> DataFrame:
        return self._stored(self.refreshed_path, schemas.REFRESHED_UNTIL)

    def _stored(self, path: str, schema: StructType) -> DataFrame:
        """A table, empty as long as nothing has been written."""
        return optional_source(self.spark, path, schema).select(*schema.names)


# --- bronze ---------------------------------------------------------------------------------


def new_run_id() -> str:
    """An id for a run; later runs have larger ids."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"


def land_series(lake: Lake, rows: DataFrame, series_id: str, source_api: str, params: dict[str, str], run_id: str | None = None) -> None:
    """Write one source series (obs_date, value columns) to bronze as list payloads.

    Rows keep the order in which the source delivers them: that of ``pos``
    where the frame has it (see :func:`landed.in_delivery_order`), else Spark's.
    """
    fields = [c for c in rows.columns if c != "pos"]
    ordered = rows if "pos" in rows.columns else rows.withColumn("pos", F.monotonically_increasing_id())
    request = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]))
    payloads = bronze.pack_payload(ordered.withColumn("series", F.lit(series_id)), "series", fields)
    _append(lake, payloads.withColumn("request_params", request), source_api, run_id)


def land_snapshot(lake: Lake, rows: DataFrame, series_id: str, source_api: str, params: dict[str, str], run_id: str | None = None) -> None:
    """Write scalar records to bronze, one document each."""
    request = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]))
    fields = [c for c in rows.columns if c not in ("obs_date", "pos")]
    document = F.struct(F.col("obs_date").cast("string").alias("obs_date"), *fields)
    payloads = rows.select(
        F.lit(series_id).alias("series_id"),
        (F.col("pos") if "pos" in rows.columns else F.monotonically_increasing_id()).alias("part"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"),
        request.alias("request_params"),
    )
    _append(lake, payloads, source_api, run_id)


def _land_if_possible(lake: Lake, rows: DataFrame, series_id: str, source_api: str, params: dict[str, str], run_id: str) -> None:
    """Land a best-effort layer: whatever goes wrong while it is read is logged, and the other layers go on."""
    try:
        land_series(lake, rows, series_id, source_api, params, run_id)
    except Exception:
        log.warning("skipped optional source %s", series_id, exc_info=True)


def _append(lake: Lake, payloads: DataFrame, source_api: str, run_id: str | None) -> None:
    tables.append_batch(payloads, lake.raw_path, run_id or new_run_id(), source_api)


# --- silver ---------------------------------------------------------------------------------


def _latest_documents(lake: Lake, run_id: str | None, *series_ids: str) -> DataFrame:
    """The newest batch of some series; prunes bronze to their folders.

    With ``run_id`` it is the newest as of that run: the run's own documents,
    or those a layer had before where the run landed none.
    """
    raw = lake.raw().filter(F.col("series_id").isin(list(series_ids)))
    if run_id is None:
        return bronze.latest_batch(raw)
    newest = raw.filter(F.col("batch_id") <= run_id).groupBy("series_id").agg(F.max("batch_id").alias("batch_id"))
    return raw.join(newest, ["series_id", "batch_id"], "left_semi")


def _merge_silver(lake: Lake, batch: DataFrame, indicators: list[Indicator], update: list[str]) -> None:
    """Merge a batch into silver and refresh the dimension rows of its indicators.

    The touched months are noted before silver is written, so a refresh that
    follows a lost merge works on too many months, never on too few.
    """
    codes = [i.code for i in indicators]
    known = silver.select_series(lake.dims(), *codes)
    dims = silver.upsert_dim(known, catalog.dim_rows(lake.spark, *indicators))
    tables.replace_by_key(dims, lake.dim_path, "indicator_code")

    def note(changed: DataFrame) -> None:
        tables.sink_overwrite(refresh.touched_months(changed), f"{lake.pending_path}/merge={new_run_id()}")

    merge_by_year(lake.observations_by_year, lake.observation_path, batch, update, note)


def _observations(rows: DataFrame, frequency: str, source: str, source_series_id: str) -> DataFrame:
    """Exploded rows (part, pos, indicator_code, unit, obs_date, value) as silver rows."""
    ordered = rows.withColumn("_order", bronze.payload_order())
    return silver.dedupe_last(ordered, "_order", keys=[*silver.OBSERVATION_KEY, "unit"]).select(
        "*",
        F.lit(frequency).alias("frequency"),
        F.lit(source).alias("source"),
        F.lit(source_series_id).alias("source_series_id"),
        F.current_timestamp().alias("ingested_at"),
    )


def _silver_series(lake: Lake, indicator: Indicator, series_id: str, run_id: str | None) -> None:
    documents = _latest_documents(lake, run_id, series_id)
    rows = bronze.explode_payload(documents, schemas.VALUE_PAYLOAD).withColumns(
        {"indicator_code": F.lit(indicator.code), "unit": F.lit(indicator.unit)}
    )
    batch = _observations(rows, indicator.frequency, indicator.source, series_id)
    _merge_silver(lake, batch, [indicator], silver.VALUE_ONLY)


def _is_landed(lake: Lake, series_id: str) -> bool:
    return not lake.raw().filter(F.col("series_id") == series_id).isEmpty()


def _series_values(lake: Lake, indicator: Indicator, name: str) -> DataFrame:
    rows = silver.select_series(lake.observations(), indicator.code)
    return rows.select("obs_date", F.col("value").alias(name))


# --- jobs -------------------------------------------------------------------------------------


def set_to_bronze(lake: Lake, run_id: str, quotes: DataFrame, period: str = "max") -> None:
    land_series(lake, quotes, catalog.SET_SERIES, "SET", {"period": period}, run_id)


def set_to_silver(lake: Lake, run_id: str | None = None) -> None:
    rows = bronze.explode_payload(_latest_documents(lake, run_id, catalog.SET_SERIES), schemas.QUOTE_PAYLOAD)
    fields = [
        silver.Field(column, indicator.code, indicator.unit)
        for column, indicator in (("close", catalog.SET_INDEX), ("volume", catalog.SET_VOLUME))
    ]
    batch = _observations(silver.wide_to_long(rows, fields, "part", "pos"), "D", "SET", catalog.SET_SERIES)
    _merge_silver(lake, batch, [catalog.SET_INDEX, catalog.SET_VOLUME], silver.VALUE_ONLY)


def set_to_gold(lake: Lake, as_of: AsOf) -> None:
    columns = {catalog.SET_INDEX.code: "set_index", catalog.SET_VOLUME.code: "set_volume"}
    wide = silver.long_to_wide(lake.observations(), columns)
    quality.dq_enforce(quality.dq_report(wide, "set", quality.set_suite(as_of)))
    _load_mart(lake, "set_monthly", monthly.set_monthly(lake.observations()))


def ingest_set(lake: Lake, quotes: DataFrame, as_of: AsOf, period: str = "max", run_id: str | None = None) -> None:
    """Stock index: normalised quotes (obs_date, close, volume) -> set_monthly."""
    run_id = run_id or new_run_id()
    set_to_bronze(lake, run_id, quotes, period)
    set_to_silver(lake, run_id)
    set_to_gold(lake, as_of)


def fx_to_bronze(lake: Lake, run_id: str, rates: DataFrame) -> None:
    land_series(lake, rates, catalog.FX_SERIES, "FRED", {"code": catalog.USDTHB.code}, run_id)


def fx_to_silver(lake: Lake, run_id: str | None = None) -> None:
    _silver_series(lake, catalog.USDTHB, catalog.FX_SERIES, run_id)


def fx_to_gold(lake: Lake, as_of: AsOf) -> None:
    values = _series_values(lake, catalog.USDTHB, "usdthb")
    quality.dq_enforce(quality.dq_report(values, "fx", quality.fx_suite(as_of)))
    _load_mart(lake, "fx_monthly", monthly.fx_monthly(lake.observations()))


def ingest_fx(lake: Lake, rates: DataFrame, as_of: AsOf, run_id: str | None = None) -> None:
    """Exchange rate: daily (obs_date, value) -> fx_monthly."""
    run_id = run_id or new_run_id()
    fx_to_bronze(lake, run_id, rates)
    fx_to_silver(lake, run_id)
    fx_to_gold(lake, as_of)


def policy_rate_to_bronze(
    lake: Lake, run_id: str, snapshot: DataFrame, backfill: DataFrame | None = None, statistics: DataFrame | None = None
) -> None:
    """The two history layers are best effort."""
    params = {"code": catalog.POLICY_RATE.code}
    land_snapshot(lake, snapshot, catalog.POLICY_EVENT_SERIES, "BOT", params, run_id)
    for series_id, rows in (
        (catalog.POLICY_BACKFILL_SERIES, backfill),
        (catalog.POLICY_STATISTICS_SERIES, statistics),
    ):
        if rows is not None:
            _land_if_possible(lake, rows, series_id, "BOT", params, run_id)


def policy_rate_to_silver(lake: Lake, run_id: str | None = None) -> None:
    documents = _latest_documents(lake, run_id, *[layer.tag for layer in catalog.POLICY_LAYERS])
    is_event = F.col("series_id") == catalog.POLICY_EVENT_SERIES
    history = bronze.explode_payload(documents.filter(~is_event), schemas.VALUE_PAYLOAD)
    events = bronze.scalar_payload(documents.filter(is_event), schemas.SCALAR_PAYLOAD, "series_id", "part")
    columns = ["series_id", "obs_date", "value"]
    rows = history.select(*columns, bronze.payload_order().alias("pos")).unionByName(
        events.select(*columns, F.col("part").alias("pos"))
    )
    collapsed = silver.collapse_layers(
        rows.withColumn("indicator_code", F.lit(catalog.POLICY_RATE.code)), catalog.POLICY_LAYERS
    ).select(
        "*",
        F.lit(catalog.POLICY_RATE.unit).alias("unit"),
        F.lit(catalog.POLICY_RATE.frequency).alias("frequency"),
        F.current_timestamp().alias("ingested_at"),
    )
    _merge_silver(lake, collapsed, [catalog.POLICY_RATE], silver.VALUE_AND_SOURCE)


def policy_rate_to_gold(lake: Lake, as_of: AsOf) -> None:
    values = _series_values(lake, catalog.POLICY_RATE, "policy_rate")
    quality.dq_enforce(quality.dq_report(values, "policy_rate", quality.policy_rate_suite()))
    _load_mart(lake, "policy_rate_monthly", monthly.policy_rate_monthly(lake.observations(), as_of))


def ingest_policy_rate(
    lake: Lake,
    snapshot: DataFrame,
    as_of: AsOf,
    backfill: DataFrame | None = None,
    statistics: DataFrame | None = None,
    run_id: str | None = None,
) -> None:
    """Policy rate from three layers -> policy_rate_monthly."""
    run_id = run_id or new_run_id()
    policy_rate_to_bronze(lake, run_id, snapshot, backfill, statistics)
    policy_rate_to_silver(lake, run_id)
    policy_rate_to_gold(lake, as_of)


def inflation_to_bronze(lake: Lake, run_id: str, cpi: DataFrame | None) -> None:
    """Best effort."""
    if cpi is not None:
        _land_if_possible(lake, cpi, catalog.CPI_SERIES, "IMF", {"code": catalog.CPI_YOY.code}, run_id)


def inflation_to_silver(lake: Lake, run_id: str | None = None) -> None:
    """Without a new file the last landed batch is used; if there is none, silver stays as it is and the gate decides."""
    if _is_landed(lake, catalog.CPI_SERIES):
        _silver_series(lake, catalog.CPI_YOY, catalog.CPI_SERIES, run_id)


def inflation_to_gold(lake: Lake) -> None:
    values = _series_values(lake, catalog.CPI_YOY, "cpi_yoy")
    quality.dq_enforce(quality.dq_report(values, "cpi", quality.cpi_suite()))
    _load_mart(lake, "cpi_monthly", monthly.cpi_monthly(lake.observations()))


def ingest_inflation(lake: Lake, cpi: DataFrame | None, run_id: str | None = None) -> None:
    """Inflation: monthly (obs_date, value) -> cpi_monthly."""
    run_id = run_id or new_run_id()
    inflation_to_bronze(lake, run_id, cpi)
    inflation_to_silver(lake, run_id)
    inflation_to_gold(lake)


def bond_to_bronze(lake: Lake, run_id: str, yields: DataFrame) -> None:
    land_series(lake, yields, catalog.BOND_SERIES, "BOT_STAT", {"code": catalog.BOND_10Y.code}, run_id)


def bond_to_silver(lake: Lake, run_id: str | None = None) -> None:
    _silver_series(lake, catalog.BOND_10Y, catalog.BOND_SERIES, run_id)


def bond_to_gold(lake: Lake) -> None:
    values = _series_values(lake, catalog.BOND_10Y, "bond_10y")
    quality.dq_enforce(quality.dq_report(values, "bond", quality.bond_suite()))
    _load_mart(lake, "bond_monthly", monthly.bond_monthly(lake.observations()))


def ingest_bond(lake: Lake, yields: DataFrame, run_id: str | None = None) -> None:
    """Bond yield: monthly (obs_date, value) -> bond_monthly."""
    run_id = run_id or new_run_id()
    bond_to_bronze(lake, run_id, yields)
    bond_to_silver(lake, run_id)
    bond_to_gold(lake)


def refresh_dashboard(lake: Lake, as_of: AsOf) -> None:
    """Bring the stored dashboard up to the silver rows merged since the last refresh, and to ``as_of``.

    Reads silver only in the noted months. A refresh that is cut short is done
    whole by the next one: the notes go last.
    """
    pending = lake.pending()
    merges = [r.merge for r in pending.select("merge").distinct().collect()]
    touched = kept(pending.filter(F.col("merge").isin(merges)).select(*refresh.MONTH).distinct())
    if merges:
        parts = tables.partitions_of(touched.withColumn("obs_year", F.year("obs_month")), *BY_YEAR)
        rows = tables.in_partitions(lake.observations_by_year(), parts)
        codes = list({p.indicator_code for p in parts})
        facts = refresh.refreshed_facts(silver.select_series(lake.facts(), *codes), rows, touched)
        tables.replace_by_key(kept(facts), lake.facts_path, "indicator_code")
    last = lake.refreshed_until().first()
    facts = lake.facts()
    affected = refresh.affected_months(facts, touched, as_of, last and last.as_of)
    dashboard = refresh.refreshed_dashboard(lake.dashboard(), facts, affected, as_of)
    tables.sink_truncate_load(dashboard, lake.dashboard_path, schemas.DASHBOARD_MONTHLY)
    until = lake.spark.range(1).select(F.lit(str(as_of)).cast("date").alias("as_of"))
    tables.sink_truncate_load(until, lake.refreshed_path, schemas.REFRESHED_UNTIL)
    for merge in merges:
        tables.remove(lake.spark, f"{lake.pending_path}/merge={merge}")


def refresh_forecasts(lake: Lake, *codes: str, periods: int = forecast.PERIODS) -> None:
    """Refit the given indicators (all by default) and replace only their rows of forecast_monthly."""
    chosen = [f for f in catalog.FORECASTS if not codes or f[0] in codes]
    if unknown := set(codes) - {f[0] for f in chosen}:
        raise ValueError(f"no forecast is defined for {', '.join(sorted(unknown))}")
    actuals = None
    for code, mart, column in chosen:
        series = forecast.actuals_series(lake.mart(mart), column, code)
        actuals = series if actuals is None else actuals.unionByName(series)
    forecast.require_two_seasons(actuals, expected=[code for code, _, _ in chosen])
    ahead = forecast.hw_band(forecast.hw_fit_optimised(actuals), periods)
    # The gate and the write below read the same fit: store it once instead of fitting twice.
    staging = shared_dir(lake.spark)
    tables.sink_overwrite(ahead, staging)
    ahead = tables.scan_parquet(lake.spark, staging, ahead.schema)
    report = quality.dq_report(ahead, "forecast", quality.forecast_suite(periods), ["indicator"])
    quality.dq_enforce(report)
    tables.replace_by_key(forecast.forecast_monthly(actuals, ahead), lake.forecast_path, "indicator", [code for code, _, _ in chosen])


def _load_mart(lake: Lake, name: str, mart: DataFrame) -> None:
    tables.sink_truncate_load(mart, lake.mart_path(name), MART_SCHEMAS[name])


# --- views ----------------------------------------------------------------------------------


def gold_views(lake: Lake) -> dict[str, DataFrame]:
    """The gold layer by name: stored marts and the views over them."""
    marts = {name: lake.mart(name) for name in MART_SCHEMAS}
    dashboard = crossmart.dashboard_monthly(
        marts["set_monthly"],
        marts["fx_monthly"],
        marts["policy_rate_monthly"],
        marts["cpi_monthly"],
        marts["bond_monthly"],
    )
    return {
        **marts,
        "dashboard_monthly": dashboard,
        "real_rate_monthly": crossmart.real_rate_monthly(marts["policy_rate_monthly"], marts["cpi_monthly"]),
        "correlation_matrix": crossmart.correlation_matrix(dashboard),
        "forecast_monthly": lake.forecasts(),
    }


def ask(lake: Lake, statement: str) -> DataFrame:
    """Answer one screened SELECT over the gold layer."""
    return serving.guarded_gold_query(lake.spark, statement, lambda session: gold_views(replace(lake, spark=session)))
