"""Declared schemas of every layer. Nothing is inferred at run time."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


_TEXT, _DATE, _NUM = StringType(), DateType(), DoubleType()
_LONG, _TS, _BOOL, _INT = LongType(), TimestampType(), BooleanType(), IntegerType()

# Landed source files.
MONTHLY_STATISTICS = _struct(period_start=_TEXT, value=_TEXT)
POLICY_SNAPSHOT = _struct(effective_datetime=_TEXT, data=_TEXT, news_text_th=_TEXT, news_text_en=_TEXT)
PERIOD_SERIES = _struct(period=_TS, value=_NUM)
DAILY_SERIES = _struct(obs_date=_DATE, value=_NUM)
QUOTES = _struct(Date=_DATE, Close=_NUM, Volume=_NUM)

# Bronze: raw envelopes; payload and request_params are JSON text.
RAW_OBSERVATION = _struct(
    batch_id=_TEXT,
    source_api=_TEXT,
    series_id=_TEXT,
    part=_LONG,
    payload=_TEXT,
    request_params=_TEXT,
    ingested_at=_TS,
)

# Bronze payload documents.
VALUE_PAYLOAD = StructType([StructField("obs", ArrayType(_struct(obs_date=_DATE, value=_NUM)))])
QUOTE_PAYLOAD = StructType([StructField("obs", ArrayType(_struct(obs_date=_DATE, close=_NUM, volume=_NUM)))])
SCALAR_PAYLOAD = _struct(obs_date=_DATE, value=_NUM, news_th=_TEXT, news_en=_TEXT, raw=_TEXT)

# Silver: one value per indicator and day.
MACRO_OBSERVATION = _struct(
    indicator_code=_TEXT,
    obs_date=_DATE,
    value=_NUM,
    unit=_TEXT,
    frequency=_TEXT,
    source=_TEXT,
    source_series_id=_TEXT,
    ingested_at=_TS,
)
INDICATOR_DIM = _struct(
    indicator_code=_TEXT,
    name_th=_TEXT,
    name_en=_TEXT,
    category=_TEXT,
    unit=_TEXT,
    frequency=_TEXT,
    source=_TEXT,
    description=_TEXT,
)

# Gold: monthly marts.
SET_MONTHLY = _struct(obs_month=_DATE, set_close=_NUM, set_volume=_NUM, set_mom=_NUM)
FX_MONTHLY = _struct(obs_month=_DATE, usdthb=_NUM, usdthb_mom=_NUM)
POLICY_RATE_MONTHLY = _struct(obs_month=_DATE, policy_rate=_NUM)
CPI_MONTHLY = _struct(obs_month=_DATE, cpi_yoy=_NUM)
BOND_MONTHLY = _struct(obs_month=_DATE, bond_10y=_NUM)
FORECAST_MONTHLY = _struct(
    obs_month=_DATE,
    indicator=_TEXT,
    yhat=_NUM,
    yhat_lower=_NUM,
    yhat_upper=_NUM,
    is_forecast=_BOOL,
    model=_TEXT,
    generated_at=_TS,
)

# Gold: what the incremental refresh keeps. The year columns are the folders of partitioned tables.
OBSERVATION_BY_YEAR = StructType([*MACRO_OBSERVATION, StructField("obs_year", _INT)])
MONTHLY_FACTS = _struct(obs_month=_DATE, last=_NUM, sum=_NUM, avg=_NUM, indicator_code=_TEXT)
DASHBOARD_MONTHLY = _struct(
    obs_month=_DATE,
    set_close=_NUM,
    set_mom=_NUM,
    set_volume=_NUM,
    usdthb=_NUM,
    usdthb_mom=_NUM,
    policy_rate=_NUM,
    cpi_yoy=_NUM,
    bond_10y=_NUM,
    real_rate=_NUM,
)
PENDING_MONTHS = _struct(indicator_code=_TEXT, obs_month=_DATE, merge=_TEXT)
REFRESHED_UNTIL = _struct(as_of=_DATE)
