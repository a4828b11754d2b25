"""Fill-in-the-middle transformation with content-defined chunks and memoised line boundaries.

A text is cut by a rolling hash into chunks that depend on their content only,
so that passages which documents share become equal chunks. A worker keeps a
summary for each chunk it has seen: number of line ends and code points, and
the places of the line ends. The cache is keyed by a hash of the chunk and
verified against its bytes. Running sums of the chunks' counts give the lines
of a document, lead to the chunk that holds a cut, and its summary to the place.

Documents are cut after lines at two places that a hash of the document's id
picks; prefix, middle and suffix are rearranged behind the marks ``<P>``,
``<S>`` and ``<M>``. No piece of a text that holds no mark can form one with a
mark next to it across the cuts, since marks hold no ``<`` but the first sign,
so :func:`restored` finds the marks by plain search.

Rows: a null or empty text, or one with a mark in it, is left as it is (form
``plain``, no counts of characters). A null ``doc_id`` is hashed as an empty
number. Repeated rows give repeated results. Other columns are not read,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import bounded_batches, text_of

#: Bytes that the rolling hash sees, which is also the least size of a chunk; the mean size beyond it; the largest.
WINDOW, MEAN, LARGEST = 64, 1024, 1 << 16
#: Bytes of chunks whose summaries a worker keeps.
REMEMBERED = 32 << 20
#: Percent of the documents that are rearranged, and of those the percent with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: One random number for each byte value, from the splitmix64 sequence.
_GEAR = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
for _shift, _factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
    _GEAR = (_GEAR ^ (_GEAR >> np.uint64(_shift))) * np.uint64(_factor)
_GEAR ^= _GEAR >> np.uint64(31)


def cut_marks(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last ``WINDOW`` bytes asks for a cut.

    The hash of a window is the sum of its bytes' numbers, shifted by their
    distance; windows double in length until they are long enough.
    """
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint64(width)
        width *= 2
    return np.flatnonzero(h >> np.uint64(64 - (MEAN - 1).bit_length()) == 0) + 1


def chunk_ends(marks: np.ndarray, begin: int, end: int) -> list[int]:
    """The ends of the chunks of the text between two positions; ``marks`` are those of the whole buffer."""
    ends, last = [], begin
    for mark in marks[np.searchsorted(marks, begin + WINDOW) : np.searchsorted(marks, end)].tolist():
        if mark - last >= WINDOW:
            while mark - last > LARGEST:
                last += LARGEST
                ends.append(last)
            ends.append(mark)
            last = mark
    while end - last > LARGEST:
        last += LARGEST
        ends.append(last)
    if end > last:
        ends.append(end)
    return ends


class Summary(NamedTuple):
    """A chunk's code points, and for each line end in it the bytes and the code points up to and with it."""

    chars: int
    line_bytes: np.ndarray
    line_chars: np.ndarray


def summary(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    chars = np.cumsum((data & 0xC0) != 0x80)
    ends = np.flatnonzero(data == 10)
    return Summary(int(chars[-1]), ends + 1, chars[ends])


class Memory:
    """Summaries of the chunks a worker has seen."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.held, self.hits, self.misses = limit, 0, 0, 0
        self.seen: dict[int, tuple[bytes, Summary]] = {}

    def get(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        known = self.seen.get(key)
        if known is not None and known[0] == chunk:
            self.hits += 1
            return known[1]
        self.misses += 1
        found = summary(chunk)
        if self.held + len(chunk) > self.limit:
            self.seen.clear()
            self.held = 0
        if len(chunk) <= self.limit:
            self.held += len(chunk) - (len(known[0]) if key in self.seen else 0)
            self.seen[key] = (chunk, found)
        return found


def chosen(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that belong to a document."""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def located(parts: list[Summary], lines: int, size: int, sizes: np.ndarray, cut: int) -> tuple[int, int]:
    """(bytes, code points) before the end of line ``cut`` of a text with so many ``lines`` and bytes."""
    if cut == 0:
        return 0, 0
    counts = np.cumsum([len(p.line_bytes) for p in parts])
    chars = np.cumsum([p.chars for p in parts])
    if cut == lines:  # the last line may lack its end
        return size, int(chars[-1])
    i = int(np.searchsorted(counts, cut))
    nth = cut - int(counts[i]) - 1
    before = (int(sizes[i - 1]), int(chars[i - 1])) if i else (0, 0)
    return before[0] + int(parts[i].line_bytes[nth]), before[1] + int(parts[i].line_chars[nth])


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def rearranged(batch: pa.RecordBatch, memory: Memory, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> pa.RecordBatch:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for a batch of (doc_id, text)."""
    texts = batch.column(1)
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist()
    raw = texts.buffers()[2].to_pybytes() if texts.buffers()[2] else b""
    marks = cut_marks(np.frombuffer(raw, np.uint8))
    rows = []
    for doc_id, begin, end in zip(batch.column(0).to_pylist(), edges, edges[1:]):
        text = raw[begin:end]
        ends = chunk_ends(marks, begin, end)
        parts = [memory.get(raw[a:b]) for a, b in zip([begin, *ends], ends)]
        n = sum(len(p.line_bytes) for p in parts) + (bool(text) and text[-1] != 10)
        h1, h2, h3, h4 = chosen(doc_id)
        if not text or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
            rows.append((doc_id, n, "plain", None, None, text))
            continue
        sizes = np.array(ends) - begin
        (a, a_chars), (b, b_chars) = (located(parts, n, len(text), sizes, cut) for cut in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = (m.encode() + t for m, t in ((PREFIX, text[:a]), (MIDDLE, text[a:b]), (SUFFIX, text[b:])))
        form, order = ("spm", (suffix, prefix, middle)) if h4 % 100 < suffix_first else ("psm", (prefix, suffix, middle))
        rows.append((doc_id, n, form, a_chars, b_chars - a_chars, b"".join(order)))
    *columns, output = zip(*rows)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _OUT)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(output, pa.binary()).cast(pa.string())], schema=_OUT)


def rearrange(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row for each document: (doc_id, n, form, prefix_chars, middle_chars, output)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            if batch.num_rows:
                yield rearranged(batch, memory, rate, suffix_first)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that was rearranged, from its form and output."""

    def piece(mark: str, following: str | None) -> str:
        start = f"locate('{mark}', {output}) + {len(mark)}"
        return f"substring({output}, {start}" + (f", locate('{following}', {output}) - ({start}))" if following else ")")

    psm = f"concat({piece(PREFIX, SUFFIX)}, {piece(MIDDLE, None)}, {piece(SUFFIX, MIDDLE)})"
    spm = f"concat({piece(PREFIX, MIDDLE)}, {piece(MIDDLE, None)}, {piece(SUFFIX, PREFIX)})"
    return F.expr(f"CASE {form} WHEN 'psm' THEN {psm} WHEN 'spm' THEN {spm} ELSE {output} END")


def digests(rows: DataFrame) -> DataFrame:
    """The rows with digests of the output, and of the text rebuilt from it."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


#: The same rows, from lists of lines.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines FROM documents),
hashed AS (
  SELECT doc_id, text, lines, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM parts"""
