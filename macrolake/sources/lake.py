"""Lake tables: scans and the write modes of the pipeline."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet dataset by path, under a declared schema where one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def sink_overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole dataset."""
    df.write.mode("overwrite").parquet(path)


def sink_partitioned(df: DataFrame, path: str, *keys: str) -> None:
    """Replace a dataset laid out in one folder per key value.

    The rebalance step sizes the files at run time: rows of one key meet in
    few tasks, and a key that holds a large share of the rows is split over
    several tasks instead of waiting for one.
    """
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def sink_truncate_load(df: DataFrame, path: str, schema: StructType) -> None:
    """Full rebuild of a mart that keeps the mart's declared columns, order and types.

    The rows are written to a folder beside the mart, which then takes the
    mart's place by :func:`publish`: whatever fails, the mart has either its
    old or its new rows.
    """
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    spark, staging = df.sparkSession, _beside(path, "staging")
    recover(spark, path)
    try:
        rows.write.parquet(staging)
        publish(spark, staging, path)
    finally:
        remove(spark, staging)


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Put a finished folder in the place of another, by renames within their file system.

    The old folder is set aside, the new one moved into place, the old one
    deleted. If the second step fails, the old folder is moved back; if the
    last fails, the new rows stand and the old ones are left aside, which
    :func:`recover` clears. Readers see the old or the new folder, except between
    the two renames.
    """
    aside = _beside(path, "old")
    had = _exists(spark, path)
    if had:
        _rename(spark, path, aside)
    try:
        _rename(spark, staging, path)
    except Exception:
        if had:
            _rename(spark, aside, path)
        raise
    finally:
        spark.catalog.refreshByPath(path)
    if had:
        try:
            remove(spark, aside)
        except Exception:
            log.warning("%s is published, but its old rows were left in %s", path, aside, exc_info=True)


def recover(spark: SparkSession, path: str) -> None:
    """Clean up after a load whose driver was lost: a folder set aside goes back if its place is empty, else it is deleted.

    Call it only where no other load of the same folder is running.
    """
    for aside in _siblings(spark, path, "old"):
        if _exists(spark, path):
            remove(spark, aside)
        else:
            _rename(spark, aside, path)
            spark.catalog.refreshByPath(path)


def sink_truncate_load_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Full rebuild of a database table: rows are emptied, the table and its keys stay."""
    df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)


def replace_by_key(df: DataFrame, path: str, key: str, keys: list[str] | None = None) -> None:
    """Replace only the partitions of some key values; the others stay as they are.

    The values are those found in ``df``. With ``keys`` they are the listed
    ones: a listed key without rows ends up empty, rows of other keys are not
    written.
    """
    absent: list[str] = []
    if keys is not None:
        df = df.filter(F.col(key).isin(keys))
        found = {r[0] for r in df.select(key).distinct().collect()}
        absent = [k for k in keys if k not in found]
    replace_partitions(df, path, key)
    for value in absent:
        remove(df.sparkSession, f"{path.rstrip('/')}/{key}={value}")


def replace_partitions(df: DataFrame, path: str, *parts: str) -> None:
    """Replace the partitions that ``df`` has rows for; all other folders are not touched."""
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def partitions_of(rows: DataFrame, *parts: str) -> list[Row]:
    """The distinct partitions that some rows belong to."""
    return rows.select(*parts).distinct().collect()


def in_partitions(table: DataFrame, partitions: list[Row]) -> DataFrame:
    """The rows of a partitioned table in the given partitions.

    The filter holds partition values only, so the scan lists and reads no
    other folder. Partitions that share all but the last value become one term.
    """
    last_values: dict[tuple, list] = {}
    for *outer, last in partitions:
        last_values.setdefault(tuple(outer), []).append(last)
    if not last_values:
        return table.filter(F.lit(False))
    names = partitions[0].__fields__
    wanted = F.lit(False)
    for outer, values in last_values.items():
        term = F.col(names[-1]).isin(values)
        for name, value in zip(names, outer):
            term = (F.col(name) == F.lit(value)) & term
        wanted = term if len(last_values) == 1 else wanted | term
    return table.filter(wanted)


def _beside(path: str, what: str) -> str:
    """A fresh name next to a folder."""
    return f"{path.rstrip('/')}__{what}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def _siblings(spark: SparkSession, path: str, what: str) -> list[str]:
    """The folders that :func:`_beside` named for ``path``."""
    folder, system = _folder(spark, f"{path.rstrip('/')}__{what}-*")
    return [str(s.getPath().toString()) for s in system.globStatus(folder) or []]


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that is free."""
    moved, system = _folder(spark, source)
    to, _ = _folder(spark, target)
    if system.exists(to) or not system.rename(moved, to):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def sink_overwrite_self(df: DataFrame, path: str) -> None:
    """Replace a dataset with a frame that reads the same dataset; published as by :func:`sink_truncate_load`."""
    sink_truncate_load(df, path, df.schema)


def append_batch(
    payloads: DataFrame,
    path: str,
    batch_id: str,
    source_api: str | Column,
    ingested_at: Column | None = None,
) -> None:
    """Append payload documents (series_id, part, payload, request_params) as one raw batch.

    Every series and batch has a folder of its own, and batch ids are never
    used twice, so replacing just the folders that the batch fills replaces
    nothing. Unlike the append mode this commits through a private folder:
    batches that arrive at the same time do not touch each other's files.
    """
    source = source_api if isinstance(source_api, Column) else F.lit(source_api)
    (
        envelope(payloads, batch_id, source, ingested_at)
        .hint("rebalance", "series_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("series_id", "batch_id")
        .parquet(path)
    )


def envelope(
    payloads: DataFrame, batch_id: str | Column, source_api: Column, ingested_at: Column | None = None
) -> DataFrame:
    """Payload documents in the layout of the raw table."""
    return payloads.select(
        (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).alias("batch_id"),
        source_api.alias("source_api"),
        "series_id",
        "part",
        "payload",
        "request_params",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )
