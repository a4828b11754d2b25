"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.session import shared_dir
from macrolake.sources.lake import remove

#: Bytes of one Arrow batch that goes to a Python worker; long texts make short batches.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read back: lineage ends here and survives lost executors."""
    path = f"{shared_dir(frame.sparkSession)}-{uuid.uuid4().hex[:8]}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Scratch:
    """Stored frames that are deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, frame: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}-{uuid.uuid4().hex[:8]}"
        self.paths.append(path)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove(self.spark, path)
        self.paths = []


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_of(column: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def per_batch(frame: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over each Arrow batch of the frame; it returns columns by name."""
    bounded_batches(frame.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, arrow)],
                    schema=arrow,
                )

    return frame.mapInArrow(run, schema)


def rows_where(frame: DataFrame, keep) -> DataFrame:
    """The rows of the frame for which ``keep`` is true; it gets each Arrow batch and returns a flag for each row."""
    bounded_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return frame.mapInArrow(run, frame.schema)
