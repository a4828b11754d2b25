"""Silver: one value per (indicator_code, obs_date), merged without a unique index."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBSERVATION_KEY = ["indicator_code", "obs_date"]
#: The columns that a merge of one source changes, and those that a merge of layers changes.
VALUE_ONLY = ["value"]
VALUE_AND_SOURCE = ["value", "source", "source_series_id"]


@dataclass(frozen=True)
class Field:
    """A wide column and the indicator it becomes."""

    column: str
    indicator_code: str
    unit: str


def wide_to_long(wide: DataFrame, fields: list[Field], *keep: str) -> DataFrame:
    """(obs_date, one column per field) -> (obs_date, indicator_code, unit, value), in one pass.

    ``keep`` names further columns to repeat on every row.
    """
    cells: list[Column] = []
    for f in fields:
        cells += [F.lit(f.indicator_code), F.lit(f.unit), F.col(f.column).cast("double")]
    stacked = F.stack(F.lit(len(fields)), *cells).alias("indicator_code", "unit", "value")
    return wide.select("obs_date", *keep, stacked)


def dedupe_last(rows: DataFrame, pos: str | Column = "pos", value: str = "value", keys: list[str] | None = None) -> DataFrame:
    """One row per key: the value of the row that comes last in ``pos`` order.

    A last row with a null value keeps its null. Both aggregation buffers are
    fixed-width, so duplicates collapse in a hash aggregate before the shuffle.
    """
    return rows.groupBy(*(keys or OBSERVATION_KEY)).agg(F.max_by(value, pos).alias(value))


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Insert the batch rows whose key is new; where the key exists, change only the ``update`` columns.

    Key columns are unique on both sides. A null in the batch wins over an old
    value; target rows that the batch does not have stay. Columns missing from
    the batch are null for inserted rows.
    """
    others = [c for c in target.columns if c not in keys]
    known = [c for c in others if c in batch.columns]
    old = target.select(*keys, F.struct(*others).alias("_old"))
    new = batch.select(*keys, F.struct(*known).alias("_new"))

    def pick(name: str) -> Column:
        before = F.col("_old")[name]
        after = F.col("_new")[name] if name in known else F.lit(None).cast(target.schema[name].dataType)
        if name in update:
            return F.when(F.col("_new").isNotNull(), after).otherwise(before).alias(name)
        return F.when(F.col("_old").isNotNull(), before).otherwise(after).alias(name)

    return old.join(new, keys, "full_outer").select(
        *[F.col(c) if c in keys else pick(c) for c in target.columns]
    )


def changed_rows(target: DataFrame, batch: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """The batch rows that a merge would write: those with a new key, or with another value in an ``update`` column.

    Sources deliver their whole history each time; this leaves what is new in
    it. A null and a value differ, two nulls do not.
    """
    old = target.select(*keys, F.struct(*update).alias("_old"))
    same = F.col("_old").eqNullSafe(F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in update]))
    return batch.join(old, keys, "left").filter(F.col("_old").isNull() | ~same).select(*batch.columns)


def upsert_value(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge observations: on conflict only ``value`` changes.

    unit, frequency, source, source_series_id and ingested_at keep what the
    first insert gave them.
    """
    return merge_by_key(target, batch, OBSERVATION_KEY, VALUE_ONLY)


def upsert_dim(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge dimension rows: on conflict only ``name_en`` changes."""
    return merge_by_key(target, batch, ["indicator_code"], ["name_en"])


@dataclass(frozen=True)
class Layer:
    """One source of a layered indicator: the value of its tag, and what silver records about it."""

    tag: str
    source: str
    source_series_id: str


def collapse_layers(rows: DataFrame, layers: list[Layer], tag: str = "series_id") -> DataFrame:
    """One row per key: the last row of the highest layer that has the key.

    ``rows`` holds (indicator_code, obs_date, value, pos) of all layers, told
    apart by ``tag``; ``layers`` come in rising precedence, and one without
    rows changes nothing. Each layer keeps its own fixed-width buffer in one
    hash aggregate, so the whole choice is a single shuffle with map-side
    combine; texts are attached after it.
    """

    best = (
        rows.filter(F.col(tag).isin([layer.tag for layer in layers]))
        .withColumn("_rank", F.array_position(_texts(layer.tag for layer in layers), F.col(tag)))
        .groupBy(*OBSERVATION_KEY)
        .agg(
            F.max("_rank").alias("_best"),
            *[F.expr(f"max_by(value, if(_rank = {i}, pos, null)) as _value{i}") for i in range(1, len(layers) + 1)],
        )
    )
    values = F.array(*[f"_value{i}" for i in range(1, len(layers) + 1)])
    return best.select(
        *OBSERVATION_KEY,
        F.element_at(values, F.col("_best").cast("int")).alias("value"),
        F.element_at(_texts(layer.source for layer in layers), F.col("_best").cast("int")).alias("source"),
        F.element_at(_texts(layer.source_series_id for layer in layers), F.col("_best").cast("int")).alias(
            "source_series_id"
        ),
    )


def _texts(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def layered_upsert(target: DataFrame, collapsed: DataFrame) -> DataFrame:
    """Merge collapsed layers: on conflict value, source and source_series_id change."""
    return merge_by_key(target, collapsed, OBSERVATION_KEY, VALUE_AND_SOURCE)


def long_to_wide(long: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pivot indicators to columns by obs_date; ``columns`` maps each indicator to its column name.

    Keys are unique, so ``max`` of a cell is the cell. It is a plain hash
    aggregate with one buffer per column and needs no pass to find the codes.
    """
    cells = [
        F.max(F.when(F.col("indicator_code") == code, F.col("value"))).alias(name)
        for code, name in columns.items()
    ]
    return select_series(long, *columns).groupBy("obs_date").agg(*cells)


def select_series(long: DataFrame, *codes: str) -> DataFrame:
    """The rows of the given indicators; prunes folders of a table laid out by indicator_code."""
    return long.filter(F.col("indicator_code").isin(list(codes)))
