"""Bronze: raw payload documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Observations per payload document. A series longer than this becomes several parts.
PART_SIZE = 10_000
#: Positions within a document take this many bits of :func:`payload_order`.
_POSITION_BITS = 20


def pack_payload(
    rows: DataFrame,
    series: str,
    fields: list[str],
    pos: str = "pos",
    part_size: int = PART_SIZE,
    request_params: Column | None = None,
) -> DataFrame:
    """Pack each series into JSON documents ``{"obs": [...]}`` in ``pos`` order.

    ``pos`` is a whole number, unique within a series. It also decides the
    part a row belongs to (``pos div part_size``), so no document and no task
    ever holds more than ``part_size`` observations however long a series is;
    the parts of a series in ``part`` order are the whole series.
    """
    if not 0 < part_size <= 1 << _POSITION_BITS:
        raise ValueError(f"part_size must be between 1 and {1 << _POSITION_BITS}")
    obs = F.struct(F.col(pos).alias("_pos"), *[_json_value(rows, name) for name in fields])
    ordered = F.array_sort(F.collect_list(obs))
    without_pos = F.transform(ordered, lambda o: F.struct(*[o[name].alias(name) for name in fields]))
    params = F.to_json(F.struct(F.col("series_id").alias("code"))) if request_params is None else request_params
    return (
        rows.groupBy(F.col(series).alias("series_id"), F.expr(f"`{pos}` div {part_size}").alias("part"))
        .agg(without_pos.alias("obs"))
        .select(
            "series_id",
            "part",
            F.to_json(F.struct("obs"), {"ignoreNullFields": "false"}).alias("payload"),
            params.alias("request_params"),
        )
    )


def _json_value(rows: DataFrame, name: str) -> Column:
    """Dates travel as text, numbers as numbers."""
    column = F.col(name)
    return (column.cast("string") if rows.schema[name].dataType.typeName() == "date" else column).alias(name)


def latest_batch(raw: DataFrame) -> DataFrame:
    """All documents of the newest batch of every series; equal times go to the larger batch_id.

    The winner is found on three narrow columns. Stored bronze has a folder for
    each series and batch, so the semi join with the winners prunes the folders
    at run time and only the payloads of the newest batches are read.
    """
    batches = raw.groupBy("series_id", "batch_id").agg(F.max("ingested_at").alias("ingested_at"))
    winner = batches.groupBy("series_id").agg(
        F.max_by("batch_id", F.struct("ingested_at", "batch_id")).alias("batch_id")
    )
    return raw.join(winner, ["series_id", "batch_id"], "left_semi")


def explode_payload(raw: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """List payloads -> one row per observation with its position ``pos`` in the document."""
    keep = keep or ("series_id", "part")
    obs = F.from_json("payload", schema, {"mode": "FAILFAST"})["obs"]
    fields = [f.name for f in schema["obs"].dataType.elementType]
    return raw.select(*keep, F.posexplode(obs).alias("pos", "o")).select(
        *keep, "pos", *[F.col("o")[name].alias(name) for name in fields]
    )


def scalar_payload(raw: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """Scalar payloads -> one row per document."""
    keep = keep or ("series_id",)
    fields = F.from_json("payload", schema, {"mode": "FAILFAST"})
    return raw.select(*keep, fields.alias("p")).select(*keep, *[F.col("p")[f.name].alias(f.name) for f in schema])


def payload_order() -> Column:
    """The position of an exploded row in its whole series, as one number."""
    return F.shiftleft(F.col("part"), _POSITION_BITS) + F.col("pos")
