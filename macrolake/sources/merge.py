"""Merging a batch into observations that are laid out by indicator and year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.operators.silver import OBSERVATION_KEY, changed_rows, merge_by_key
from macrolake.session import shared_dir
from macrolake.sources.lake import in_partitions, partitions_of, replace_partitions, scan_parquet, sink_overwrite

#: Folders of the table: a merge rewrites the years in which it changes something.
BY_YEAR = ("indicator_code", "obs_year")


def kept(frame: DataFrame) -> DataFrame:
    """A frame computed once, read back from the shared folder."""
    path = shared_dir(frame.sparkSession)
    sink_overwrite(frame, path)
    return scan_parquet(frame.sparkSession, path, frame.schema)


def with_year(rows: DataFrame) -> DataFrame:
    return rows.withColumn("obs_year", F.year("obs_date"))


def merge_by_year(
    table: Callable[[], DataFrame], path: str, batch: DataFrame, update: list[str], before_write: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """Merge ``batch`` (unique keys) into the table at ``path``; returns the batch rows that changed something.

    ``table`` reads the table, with ``obs_year``. The batch is compared with the
    years it has rows for, found from the batch first, so that no other folder
    is read; only the years in which a row is new or has another value in an
    ``update`` column are rewritten. A batch that brings nothing new writes
    nothing. ``before_write`` gets the changed rows before the table changes.
    """
    batch = kept(with_year(batch))
    there = in_partitions(table(), partitions_of(batch, *BY_YEAR))
    changed = kept(changed_rows(there, batch, OBSERVATION_KEY, update))
    touched = partitions_of(changed, *BY_YEAR)
    if touched:
        if before_write is not None:
            before_write(changed)
        target = in_partitions(table(), touched)
        replace_partitions(merge_by_key(target, changed, OBSERVATION_KEY, update), path, *BY_YEAR)
    return changed
