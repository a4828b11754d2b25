"""Landed source files: reading and per-source normalisation.

Each normaliser turns one source layout into (obs_date, value...) rows. They
are narrow projections and filters, so they stay inside the scan stage.
"""

from __future__ import annotations

import csv
import datetime as dt
import logging
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from macrolake import schemas
from macrolake.functions.dates import as_date

log = logging.getLogger(__name__)


def read_landed(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", **options: str
) -> DataFrame:
    """A landed dataset under a declared schema; bad records are an error, not a null."""
    reader = spark.read.schema(schema).format(file_format)
    if file_format in ("csv", "json"):
        reader = reader.option("mode", "FAILFAST")
    if file_format == "csv":
        reader = reader.option("header", "true")
    return reader.options(**options).load(path)


def in_delivery_order(rows: DataFrame) -> DataFrame:
    """A frame just read from files, with the order of delivery as ``pos``.

    Later files come after earlier ones, files of one time in the order of
    their paths, rows as they stand in their file. Spark itself reads large
    files first and several at once, so the order is taken from the file metadata
    and a range-partitioned sort; it is the same at any number of partitions.
    Normalisers keep ``pos``, and landing stores it.
    """
    meta = F.col("_metadata")
    placed = rows.select(
        "*",
        F.struct(
            meta["file_modification_time"].alias("time"),
            meta["file_path"].alias("path"),
            meta["file_block_start"].alias("block"),
            # A block is read by one task from its start to its end.
            F.monotonically_increasing_id().alias("row"),
        ).alias("_delivered"),
    )
    return placed.orderBy("_delivered").withColumn("pos", F.monotonically_increasing_id()).drop("_delivered")


def _kept(rows: DataFrame) -> list[str]:
    """The order of delivery, where a frame has it."""
    return ["pos"] if "pos" in rows.columns else []


def optional_source(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", **options: str
) -> DataFrame:
    """A best-effort source: a missing path is logged and gives an empty frame.

    The empty frame has the declared schema, so unions and merges downstream
    go on with the other sources.
    """
    try:
        return read_landed(spark, path, schema, file_format, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("skipped optional source %s: not found", path)
        return empty_frame(spark, schema)


def read_with_header_rows(spark: SparkSession, path: str, levels: int = 2, separator: str = "|", schema: StructType | None = None) -> DataFrame:
    """CSV files whose column names are spread over several header rows, such as field and ticker.

    A column is named by its levels, joined by ``separator``; levels that
    repeat the first column's label (``Price``, ``Ticker``) or are empty do not
    count. A further row that labels the first column alone (``Date``) names it.
    Names come from the first lines of one file; nothing is inferred from the
    data. All files must have the same header rows. Columns are text, or
    of the type ``schema`` gives their field; text that is no such value and
    rows of another width are errors.
    """
    lines = [next(csv.reader([r.value])) for r in _first_lines(spark, path, levels + 1)]
    if len(lines) < levels:
        raise ValueError(f"{path} has fewer than {levels} header rows")
    header, label = lines[:levels], None
    if len(lines) > levels and lines[levels] and lines[levels][0] and not any(lines[levels][1:]):
        header, label = lines, lines[levels][0]
    first = label or header[0][0]
    names = [first] + [separator.join(x for x in column if x) for column in list(zip(*header[:levels]))[1:]]
    if len(set(names)) < len(names) or not all(names):
        raise ValueError(f"{path}: the header rows name a column twice or not at all")
    places = [f"_c{i}" for i in range(len(names))]
    reader = spark.read.schema(", ".join(f"{c} string" for c in places)).option("mode", "FAILFAST").option("header", "false").option("enforceSchema", "true")
    rows = reader.csv(path)
    cells = F.array(*[F.coalesce(c, F.lit("")) for c in places])
    known = [F.array(*[F.lit(x) for x in line]) for line in header]
    data = rows.filter(~F.coalesce(reduce(or_, [cells == k for k in known]), F.lit(False)))
    types = {f.name: f.dataType for f in schema or []}
    cast = [F.col(c).cast(types.get(n.split(separator)[0], StringType())).alias(n) for c, n in zip(places, names)]
    return data.select(*cast)


def _first_lines(spark: SparkSession, path: str, n: int) -> list:
    """The first lines of one file of a landed dataset."""
    lines = spark.read.text(path).select("value", F.col("_metadata")["file_path"].alias("file"))
    if (one := lines.first()) is None:
        return []
    return spark.read.text(one["file"]).limit(n).collect()


def read_statistics_document(spark: SparkSession, path: str) -> DataFrame:
    """The statistics service's JSON answer: the observations of the first series under ``result``."""
    series = StructType().add("observations", ArrayType(schemas.MONTHLY_STATISTICS))
    envelope = StructType().add("result", StructType().add("series", ArrayType(series)))
    document = read_landed(spark, path, envelope, "json", multiLine="true")
    return document.select(F.inline(F.col("result.series")[0]["observations"]))


def read_snapshot_document(spark: SparkSession, path: str) -> DataFrame:
    """The decision service's JSON answer: the declared fields of ``result``, and all of it as ``raw``."""
    raw = F.get_json_object("value", "$.result").alias("raw")
    documents = spark.read.text(path, wholetext=True).select(raw)
    return documents.select(F.from_json("raw", schemas.POLICY_SNAPSHOT, {"mode": "FAILFAST"}).alias("r"), "raw").select("r.*", "raw")


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows under a schema; the optimizer sees the emptiness and drops what depends on it."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def normalize_monthly_series(rows: DataFrame) -> DataFrame:
    """(period_start 'yyyy-MM' text, value text) -> (first of month, number), nulls dropped.

    Malformed text raises under ANSI mode, as does a missing column.
    """
    return rows.select(
        F.to_date("period_start", "yyyy-MM").alias("obs_date"),
        F.col("value").cast("double").alias("value"),
        *_kept(rows),
    ).dropna()


def normalize_event_snapshot(records: DataFrame) -> DataFrame:
    """Policy-decision records -> (obs_date, value, news_th, news_en, raw).

    The texts may be missing; ``raw`` keeps the whole record as JSON: the text
    as delivered where the records carry it, else all their columns.
    """
    delivered = [c for c in records.columns if c not in _kept(records)]
    whole = F.col("raw") if "raw" in records.columns else F.to_json(F.struct(*delivered), {"ignoreNullFields": "false"})
    return records.select(
        F.to_timestamp_ntz("effective_datetime", F.lit("yyyy-MM-dd HH:mm:ss")).cast("date").alias("obs_date"),
        F.col("data").cast("double").alias("value"),
        F.col("news_text_th").alias("news_th"),
        F.col("news_text_en").alias("news_en"),
        whole.alias("raw"),
        *_kept(records),
    )


def normalize_period_series(rows: DataFrame) -> DataFrame:
    """(period, value) -> (obs_date, value) without rows that miss either."""
    rows = drop_missing_value(rows.select("period", "value", *_kept(rows)))
    return rows.dropna(subset=["period"]).select(F.col("period").cast("date").alias("obs_date"), "value", *_kept(rows))


def drop_missing_value(rows: DataFrame, start: str | dt.date | Column | None = None) -> DataFrame:
    """Drop rows whose value is null or NaN (holidays); optionally keep obs_date >= ``start`` only."""
    present = F.col("value").isNotNull() & ~F.isnan("value")
    if start is not None:
        present = present & (F.col("obs_date") >= as_date(start))
    return rows.filter(present)


def normalize_ohlc(quotes: DataFrame, ticker_separator: str = "|") -> DataFrame:
    """Wide quotes -> (obs_date, close, volume) for the days that traded.

    Column names may carry a ticker level after the field name
    (``Close|<ticker>``); the level is dropped.
    """
    fields = {name.split(ticker_separator)[0]: name for name in quotes.columns}

    def field(name: str) -> Column:
        return quotes[f"`{fields[name]}`"]

    return quotes.select(
        field("Date").cast("date").alias("obs_date"),
        field("Close").cast("double").alias("close"),
        field("Volume").cast("double").alias("volume"),
        *_kept(quotes),
    ).filter(F.col("volume") > 0)
