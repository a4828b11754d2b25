"""The indicators of the lake and where they come from. Fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.operators.silver import Layer
from macrolake.schemas import INDICATOR_DIM


@dataclass(frozen=True)
class Indicator:
    code: str
    name_th: str
    name_en: str
    category: str
    unit: str
    frequency: str
    source: str


SET_INDEX = Indicator("TH.SET_INDEX", "ดัชนีตลาดหลักทรัพย์ไทย", "SET Index", "market", "points", "D", "SET")
SET_VOLUME = Indicator("TH.SET_VOLUME", "ปริมาณซื้อขาย SET", "SET Volume", "market", "shares", "D", "SET")
USDTHB = Indicator(
    "FX.USDTHB", "อัตราแลกเปลี่ยน USD/THB", "USD/THB Exchange Rate", "external", "THB per USD", "D", "FRED"
)
POLICY_RATE = Indicator("TH.POLICY_RATE", "อัตราดอกเบี้ยนโยบาย", "Policy Rate", "monetary", "percent", "M", "BOT")
CPI_YOY = Indicator("TH.CPI_YOY", "เงินเฟ้อทั่วไป (YoY)", "Headline CPI YoY", "real", "percent", "M", "IMF")
BOND_10Y = Indicator(
    "TH.BOND_10Y", "ผลตอบแทนพันธบัตรรัฐบาล 10 ปี", "Govt Bond Yield 10Y", "rates", "percent", "M", "BOT"
)

SET_SERIES = "^SET.BK"
FX_SERIES = "DEXTHUS"
CPI_SERIES = "IMF/IFS/M.TH.PCPI_PC_CP_A_PT"
BOND_SERIES = "FMRTINTM00296"
POLICY_BACKFILL_SERIES = "BIS/WS_CBPOL/M.TH"
POLICY_STATISTICS_SERIES = "FMRTINTM00262"
POLICY_EVENT_SERIES = "BOT/policy_rate"

#: Sources of the policy rate in rising precedence.
POLICY_LAYERS = [
    Layer(POLICY_BACKFILL_SERIES, "BIS", POLICY_BACKFILL_SERIES),
    Layer(POLICY_STATISTICS_SERIES, "BOT_STAT", POLICY_STATISTICS_SERIES),
    Layer(POLICY_EVENT_SERIES, "BOT", "policy_rate"),
]

#: Forecast indicators: code, gold mart, mart column.
FORECASTS = [(SET_INDEX.code, "set_monthly", "set_close"), (USDTHB.code, "fx_monthly", "usdthb")]


def dim_rows(spark: SparkSession, *indicators: Indicator) -> DataFrame:
    """Dimension rows of some indicators."""
    fields = ("code", "name_th", "name_en", "category", "unit", "frequency", "source")
    rows = [
        F.struct(*[F.lit(getattr(i, f)).alias(f) for f in fields], F.lit(None).cast("string").alias("description"))
        for i in indicators
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).toDF(*INDICATOR_DIM.names)
