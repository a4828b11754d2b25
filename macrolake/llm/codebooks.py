"""Vector compression by parts, with memoised grid cells for the search of the nearest entry.

Vectors of whole numbers (256 times the components, rounded down) are cut into
``PARTS`` consecutive parts. Each part position has a codebook of at most
``ENTRIES`` entries, which starts from the smallest ids and is trained by
``ROUNDS`` rounds of assignment and floored means.

A part is assigned by its grid cell: the cell is a box, and an entry whose
smallest distance to the box is above the smallest of all entries' largest
distances to it can be nearest to no point inside. The entries that are left,
a few of all, are remembered for the cell under the hash of its coordinates, and
only they are compared with the part. A part whose cell shares the hash of
another is compared with all. Equal distances are never dropped, so ties
go to the lower index as in a full search.

Each task sums its members for each entry before the shuffle, so a value that
a third of all rows have adds a row for each task. Only codebooks
reach the driver.

Rows: vectors that are null or hold a null or a component that is not finite
take no part. Repeated rows and rows without an id count each; rows of equal id
are ordered by their vectors for the start. A null label is a label. With fewer
vectors than entries the codebooks are smaller; an empty table gives no rows.
All vectors need one length that ``PARTS`` divides, and components
of at most ``LARGEST / 256``: other vectors are an error. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import bounded_batches, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Units of a component, and the largest number whose squared distances fit.
UNITS, LARGEST = 256, 1 << 24
#: Cells across the spread of a codebook's entries, and cells that a task remembers for each position.
ACROSS, REMEMBERED = 8, 20_000
#: Pieces into which equal labels are spread when their sum is joined back.
SALTS = 32

#: A distance above all others.
_FAR = np.iinfo(np.int64).max


def kept(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, x): the rows that take part, as whole numbers."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = rows.filter("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND abs(x) < DOUBLE('Infinity'))")
    return finite.select("vec_id", "label", F.expr(f"transform(v, x -> CAST(floor({UNITS} * x) AS LONG))").alias("x"))


def start(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The first codebooks, part x entry x position: those of the smallest ids; None without rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return None
    size = len(first[0].x)
    if size % parts or not size:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} parts")
    if any(len(r.x) != size for r in first):
        raise ValueError("vectors of different lengths")
    table = np.array([r.x for r in first], np.int64).reshape(len(first), parts, size // parts)
    _bounded(table)
    return table.transpose(1, 0, 2).copy()


def _bounded(x: np.ndarray) -> None:
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // UNITS}")


class Cells:
    """Nearest entries of one codebook (entry x position) by memoised cells."""

    def __init__(self, entries: np.ndarray, across: int = ACROSS, remembered: int = REMEMBERED):
        self.entries, self.remembered = entries, remembered
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max())
        self.shift = max(spread // across, 1).bit_length() - 1
        self.cells = self.compared = 0
        self.forget()

    def forget(self) -> None:
        """No cell is known."""
        self.known: dict[int, int] = {}  # the hash of a cell, and its row in the tables below
        self.corners = np.empty((0, self.entries.shape[1]), np.int64)
        self.first = np.zeros(1, np.int64)
        self.lists = np.empty(0, np.int64)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries may be nearest to a point in it."""
        low = cells << self.shift
        least, most = np.zeros((len(cells), len(self.entries)), np.int64), np.zeros((len(cells), len(self.entries)), np.int64)
        for j in range(cells.shape[1]):
            below = low[:, j, None] - self.entries[None, :, j]
            above = -below - ((1 << self.shift) - 1)
            out = np.maximum(np.maximum(below, above), 0)
            least += out * out
            out = np.maximum(np.abs(below), np.abs(above))
            most += out * out
        return least <= most.min(axis=1)[:, None]

    def remember(self, keys: list[int], cells: np.ndarray) -> None:
        for i in range(0, len(keys), 4096):  # bounds the distances held at once
            open_ = self.candidates(cells[i : i + 4096])
            self.known.update(zip(keys[i : i + 4096], range(len(self.corners), len(self.corners) + len(open_))))
            self.corners = np.concatenate([self.corners, cells[i : i + 4096]])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(open_.sum(axis=1))])
            self.lists = np.concatenate([self.lists, np.nonzero(open_)[1]])
        self.cells += len(keys)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry, ties to the lower index."""
        cells = points >> self.shift
        hashed = np.zeros(len(points), np.uint64)
        for j in range(cells.shape[1]):
            hashed = (hashed ^ (hashed >> np.uint64(29)) ^ cells[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys, at, of = np.unique(hashed, return_index=True, return_inverse=True)
        listed = keys.tolist()
        if len(self.known) + len(listed) > self.remembered:
            self.forget()
        new = [i for i, k in enumerate(listed) if k not in self.known]
        self.remember([listed[i] for i in new], cells[at[new]])
        row = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))[of]
        # Each point meets the entries of its cell, or all if another cell has its hash; the first of the smallest distances wins.
        own = (self.corners[row] == cells).all(axis=1)
        start, n = self.first[row], np.where(own, self.first[row + 1] - self.first[row], len(self.entries))
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin - start, n)
        if own.all():
            entry = self.lists[place]
        else:
            entry = np.where(np.repeat(own, n), self.lists[np.minimum(place, len(self.lists) - 1)], place - np.repeat(start, n))
        distance = np.zeros(len(entry), np.int64)
        for j in range(points.shape[1]):
            away = np.repeat(points[:, j], n) - self.entries[entry, j]
            distance += away * away
        best = np.minimum.reduceat(distance, begin)
        hits = np.flatnonzero(distance == np.repeat(best, n))
        owner = np.repeat(np.arange(len(points)), n)[hits]
        first = hits[np.append(True, owner[1:] != owner[:-1])]
        self.compared += len(entry)
        return entry[first], best


def _points(batch: pa.RecordBatch, column: int, books: np.ndarray) -> np.ndarray:
    """The vectors of a batch as row x part x position."""
    lists = batch.column(column)
    parts, _, width = books.shape
    if len(lists) and not (np.diff(lists.offsets.to_numpy()) == parts * width).all():
        raise ValueError("vectors of different lengths")
    x = lists.flatten().to_numpy().reshape(-1, parts, width)
    _bounded(x)
    return x


def trained(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floored mean of its parts, or itself without any."""
    bounded_batches(rows.sparkSession)
    parts, entries, width = books.shape
    shipped = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shipped.value
        searches = [Cells(b) for b in books]
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch, 0, books)
            for p, search in enumerate(searches):
                at = p * entries + search.nearest(x[:, p])[0]
                np.add.at(sums, at, x[:, p])
                counts += np.bincount(at, minlength=len(counts))
        used = np.flatnonzero(counts)
        if len(used):
            columns = [np.repeat(used, width), np.tile(np.arange(width), len(used)), sums[used].ravel(), np.repeat(counts[used], width)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["entry", "position", "total", "n"])

    sums = rows.select("x").mapInArrow(run, "entry long, position long, total long, n long")
    new = books.reshape(parts * entries, width).copy()
    for r in sums.groupBy("entry", "position").agg(F.sum(F.col("total").cast("decimal(38, 0)")).alias("total"), F.sum("n").alias("n")).collect():
        new[r.entry, r.position] = int(r.total) // r.n
    return new.reshape(books.shape)


def encoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): the index of each part's nearest entry, two hexadecimal digits each, and the sum of their distances."""
    bounded_batches(rows.sparkSession)
    shipped = rows.sparkSession.sparkContext.broadcast(books)
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shipped.value
        searches = [Cells(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch, 2, books)
            found = [search.nearest(x[:, p]) for p, search in enumerate(searches)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def digest(books: np.ndarray) -> str:
    """The hash of all entries' numbers by part, entry and position, as decimal text with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """The codes of all vectors, (vec_id, label, code, error), and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hexadecimal digits")
    rows = kept(vectors, vec_id, vector, label)
    books = start(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), None
    for _ in range(rounds):
        books = trained(rows, books)
    return stored(encoded(rows, books)), books


def with_label_error(codes: DataFrame, salts: int = SALTS) -> DataFrame:
    """The codes with the error summed over equal labels, nulls together.

    The sums are added before the shuffle; on the way back a label's rows are
    spread over ``salts`` keys, so a frequent label meets in several tasks.
    """
    sums = codes.groupBy(F.col("label").alias("its_label")).agg(F.sum("error").alias("label_error"))
    spread = sums.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = codes.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(vec_id, code), {salts}) AS INT)"))
    same = F.col("label").eqNullSafe(F.col("its_label")) & (F.col("salt") == F.col("its_salt"))
    return salted.join(spread, same).drop("its_label", "its_salt", "salt")


def report(codes: DataFrame, books: np.ndarray | None) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row for each vector."""
    rows = with_label_error(codes)
    return rows.select("vec_id", "code", "error", "label_error", F.lit("" if books is None else digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same codes by comparing every part with every entry."""
    steps = []
    for i in range(rounds + 1):
        book = f"book{i}"
        steps.append(f"""
near{i} AS (
  SELECT row, part, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT row, part, p, e, list_sum(list_transform(range(1, len(p) + 1), lambda j: (p[j] - q[j]) * (p[j] - q[j]))) AS d
        FROM cut JOIN {book} USING (part))
  GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
mean{i} AS (
  SELECT part, e, list(m ORDER BY j) AS q
  FROM (SELECT part, e, j, CAST(floor_div(sum(p[j]), count(*)) AS BIGINT) AS m
        FROM near{i}, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS j) GROUP BY part, e, j)
  GROUP BY part, e),
book{i + 1} AS (SELECT part, e, coalesce(m.q, b.q) AS q FROM {book} b LEFT JOIN mean{i} m USING (part, e))""")
    return f"""
WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id, x) AS row, vec_id, label, x
  FROM (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({UNITS} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
cut AS (
  SELECT row, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] AS p FROM whole, (SELECT unnest(range({parts})) AS part)),
book0 AS (SELECT part, row - 1 AS e, p AS q FROM cut WHERE row <= {entries}),{",".join(steps)},
codes AS (
  SELECT row, string_agg(lpad(printf('%x', CAST(e AS INTEGER)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row),
books AS (
  SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM whole JOIN codes USING (row), books""".replace("floor_div(sum(p[j]), count(*))", "floor(CAST(sum(p[j]) AS DOUBLE) / count(*))")
