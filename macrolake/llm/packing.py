"""Packing documents into fixed-length sequences, shortest pack first over the length histogram.

A document is its token ids and an end id. It is cut into whole sequences of
``SIZE`` ids and a rest; only the rests are packed. Each row knows its rank
among the rests of the same length, so the plan needs the histogram of lengths
and nothing else: at most ``SIZE - 1`` numbers, whatever the corpus.

The plan places lengths longest first (Krell et al. 2021). Equal packs are one
pattern with a count: a length goes to the pattern with the most room, as often
as both last, else it opens as few new packs as it needs. The rests of a run of consecutive ranks
then lie in consecutive packs of a pattern, so ranks lead back from patterns to
documents. What room is left over is filled by cutting: the emptiest packs are
taken apart, class by class of equal runs, to fill the fullest, until less than
one sequence is left, which is cut at powers of two. Packs with at most
``SLACK`` free places stay as they are, the only ones with padding.

Ranks come from the stored rows: each task that writes them numbers the rests of
a length among its own rows, and a running sum over the tasks' counts does the
rest. A length that a third of all rows have is thus spread like any other.

Rows: a null or empty text is its end id alone. Repeated rows and rows without a
``doc_id`` are documents of their own. Other columns are not read, whatever
their names. An empty table gives no pieces. The plan holds one entry for each
run of a pattern. Their number depends on the histogram's shape, hardly on its
counts: 900 patterns for 10,000 documents, 90,000 for 500 billion.
"""

from __future__ import annotations

import heapq
import os
from collections import deque
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from macrolake.llm.bpe import ship_vocabulary
from macrolake.llm.common import bounded_batches, per_batch, stored, text_of

#: Ids of a sequence, the id that ends a document, and the free places that are padded rather than filled.
SIZE, END, SLACK = 1024, 0, 8
#: Units a worker remembers, and how many the library encodes as one text.
REMEMBERED, JOINED = 800_000, 1000
#: Bits of a whole sequence's number among those of its task.
TASK_BITS = 36


# --- token ids --------------------------------------------------------------------------------


class Encoder:
    """The tokenizers library, asked once for each distinct text between two single spaces.

    No pre-token crosses a space between two other characters that are not
    white space. Texts with other white space around a space, or with strings
    of added tokens, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for piece, i in vocabulary.items() if piece.startswith("Ġ")]] = True
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.specials = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.units: dict[str, bytes | None] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def learn(self, units: list[str]) -> None:
        """Remember the packed ids of units with a space before them; None marks those whose neighbours matter."""
        clear = []
        for u in units:
            if not u or u[0].isspace() or u[-1].isspace():
                self.units[u] = None
            else:
                clear.append(u)
        parts = [clear[i : i + JOINED] for i in range(0, len(clear), JOINED)]
        for part in parts:
            ids = np.array(self.library.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(part):  # a unit with an opening piece inside
                self.units.update(zip(part, self.whole([" " + u for u in part])))
                continue
            packed, edges = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            self.units.update((u, packed[a:b]) for u, a, b in zip(part, edges, edges[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text, as the library gives them for the whole text."""
        odd = {i for i, t in enumerate(texts) if self.specials and self.specials.search(t)}
        cut = [None if i in odd else t.split(" ") for i, t in enumerate(texts)]
        needed: set[str] = set()
        for c in cut:
            if c:
                needed.update(c[1:])
        new = needed.difference(self.units)
        if len(self.units) + len(new) > REMEMBERED:
            self.units.clear()
            new = needed
        self.learn(list(new))
        out: list[bytes] = [b""] * len(texts)
        plain, heads = [], []
        for i, c in enumerate(cut):
            if c is None or (c[0] and c[0][-1].isspace()):
                odd.add(i)
                continue
            try:
                out[i] = b"".join([self.units[u] for u in c[1:]])
            except TypeError:
                odd.add(i)
                continue
            if c[0]:
                plain.append(i)
                heads.append(c[0])
        for i, head in zip(plain, self.whole(heads)):
            out[i] = head + out[i]
        for i in odd:
            out[i] = self.whole([texts[i]])[0]
        return out


_WORKER: dict[str, Encoder] = {}


def _worker_encoder(name: str) -> Encoder:
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Encoder(SparkFiles.get(name))
    return _WORKER[name]


_TOKENS = "doc_id long, doc_tokens long, rest int, part long, place long, whole long, ids binary"


def tokenized(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """The documents as ids, stored: ``part`` is the writing task, ``place`` the number of rows of the
    same rest before this one in the task, ``whole`` the number of whole sequences before it there."""
    spark = docs.sparkSession
    bounded_batches(spark)
    vocabulary = ship_vocabulary(spark, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _worker_encoder(vocabulary), TaskContext.get().partitionId()
        seen, whole = np.zeros(size, np.int64), 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [x + last for x in encoder.encode(batch.column(1).to_pylist())]
            tokens = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            rest = tokens % size
            order = np.argsort(rest, kind="stable")
            first = np.flatnonzero(np.append(True, rest[order][1:] != rest[order][:-1]))
            within = np.empty(len(ids), np.int64)
            within[order] = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            before = whole + np.cumsum(tokens // size) - tokens // size
            columns = [batch.column(0), tokens, rest.astype(np.int32), np.full(len(ids), part, np.int64), seen[rest] + within, before, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=[c.split()[0] for c in _TOKENS.split(", ")])
            seen += np.bincount(rest, minlength=size)
            whole = int(before[-1] + tokens[-1] // size)

    return stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, _TOKENS))


# --- the plan ---------------------------------------------------------------------------------


class Run(NamedTuple):
    """Ids ``cut`` to ``cut + length`` of the rests of length ``rest``; copy ``i`` of a pattern holds the one of rank ``rank + i``."""

    rest: int
    cut: int
    length: int
    rank: int


class Pattern(NamedTuple):
    """Equal packs, copies ``at`` to ``at + count`` of the runs (last, those before it)."""

    room: int
    at: int
    count: int
    runs: tuple | None

    def split(self, count: int) -> tuple[Pattern, Pattern]:
        return self._replace(count=count), self._replace(at=self.at + count, count=self.count - count)

    def add(self, run: Run) -> Pattern:
        return self._replace(room=self.room - run.length, runs=(run._replace(rank=run.rank - self.at), self.runs))

    def listed(self) -> list[Run]:
        """The runs in the order of their places, with their true ranks."""
        out, runs = [], self.runs
        while runs:
            out.append(runs[0]._replace(rank=runs[0].rank + self.at))
            runs = runs[1]
        return out[::-1]


def shortest_first(classes: list[tuple[Run, int]], size: int = SIZE) -> list[Pattern]:
    """Patterns for so many copies of each run, none of them cut."""
    by_room: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # a heap, with rooms that may have become empty

    def put(p: Pattern) -> None:
        if p.room not in by_room:
            by_room[p.room] = []
            heapq.heappush(rooms, -p.room)
        by_room[p.room].append(p)

    for run, left in sorted(classes, key=lambda c: (-c[0].length, c[0])):
        while left:
            while rooms and not by_room[-rooms[0]]:
                del by_room[-heapq.heappop(rooms)]
            if not rooms or -rooms[0] < run.length:  # no more new packs than these runs need
                pattern = Pattern(size, 0, -(-left // (size // run.length)), None)
            else:
                pattern = by_room[-rooms[0]].pop()
            if pattern.count > left:
                pattern, other = pattern.split(left)
                put(other)
            put(pattern.add(run))
            run, left = run._replace(rank=run.rank + pattern.count), left - pattern.count
    return [p for some in by_room.values() for p in some]


def filled(patterns: list[Pattern], size: int = SIZE, slack: int = SLACK) -> tuple[list[Pattern], list[tuple[Run, int]]]:
    """The patterns with their room filled, and the runs left over.

    The emptiest packs are taken apart; their runs, longest first, fill the
    fullest. Each step uses up a class of runs or of packs, and what it leaves
    of the other's length is less than half of it, so there are about ten steps
    for each pattern.
    """
    done = [p for p in patterns if p.room <= slack]
    queue = deque(sorted((p for p in patterns if p.room > slack), key=lambda p: (p.room, p.count, p.runs[0])))
    need = sum(p.room * p.count for p in queue)
    pool: list[tuple[int, Run, int]] = []

    def spare(run: Run, count: int) -> None:
        if run.length and count:
            heapq.heappush(pool, (-run.length, run, count))

    while queue:
        if not pool:
            emptiest = queue.pop()
            apart = min(emptiest.count, -(-need // size))
            need -= apart * emptiest.room
            emptiest, other = emptiest.split(apart)
            if other.count:
                queue.append(other)
            for run in emptiest.listed():
                spare(run, apart)
            continue
        pack = queue.popleft()
        _, run, copies = heapq.heappop(pool)
        if run.length >= pack.room:  # one run fills several packs
            times = min(run.length // pack.room, pack.count)
            n = min(copies, pack.count // times)
            for j in range(times):
                part, pack = pack.split(n)
                done.append(part.add(run._replace(cut=run.cut + j * pack.room, length=pack.room)))
            used = times * pack.room
            need -= used * n
            spare(run._replace(cut=run.cut + used, length=run.length - used), n)
            spare(run._replace(rank=run.rank + n), copies - n)
        else:  # several runs go into one pack
            times = min(pack.room // run.length, copies)
            n = min(pack.count, copies // times)
            part, pack = pack.split(n)
            for j in range(times):
                part = part.add(run._replace(rank=run.rank + j * n))
            need -= times * run.length * n
            spare(run._replace(rank=run.rank + times * n), copies - times * n)
            if part.room > slack:
                queue.appendleft(part)
            else:
                need -= part.room * n
                done.append(part)
        if pack.count:
            queue.appendleft(pack)
    return done, [(run, copies) for _, run, copies in pool]


def powers_of_two(runs: list[Run]) -> list[Pattern]:
    """Runs as sequences whose lengths are powers of two, largest first."""
    runs, out = runs[::-1], []
    total = sum(r.length for r in runs)
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        part = Pattern(1 << bit, 0, 1, None)
        while part.room:
            run = runs.pop()
            moved = min(part.room, run.length)
            part = part.add(run._replace(length=moved))
            if moved < run.length:
                runs.append(run._replace(cut=run.cut + moved, length=run.length - moved))
        out.append(part)
    return out


def patterns(histogram: dict[int, int], size: int = SIZE, slack: int = SLACK) -> list[Pattern]:
    """Patterns of at most ``size`` ids for so many rests of each length; what filling leaves over is packed again."""
    classes = [(Run(length, 0, length, 0), n) for length, n in histogram.items()]
    out: list[Pattern] = []
    while sum(run.length * n for run, n in classes) >= size:
        done, classes = filled(shortest_first(classes, size), size, slack)
        out += done
    return out + powers_of_two([run._replace(rank=run.rank + i) for run, n in classes for i in range(n)])


class Plan(NamedTuple):
    """Where the rests lie: a row for each run of each pattern, in the order of ``keys``, which hold its length of
    rest, cut and first rank; ``sequence`` is that of rank 0."""

    bits: int
    keys: np.ndarray
    length: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def key(self, rest, cut, rank):
        return (rest << self.bits | cut) << (62 - 2 * self.bits) | rank

    def pieces(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, cut, length, sequence, offset) of the pieces of some rests: the one at cut 0, the one where that ends, and so on."""
        row, cut, found = np.flatnonzero(rest), np.zeros(len(rest), np.int64), []
        while len(row):
            at = np.searchsorted(self.keys, self.key(rest[row], cut[row], rank[row]), "right") - 1
            found.append((row, cut[row], self.length[at], self.sequence[at] + rank[row], self.offset[at]))
            cut[row] += self.length[at]
            row = row[cut[row] < rest[row]]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 5


def plan(histogram: dict[int, int], size: int = SIZE, slack: int = SLACK) -> Plan:
    """The plan for the rests of a corpus."""
    empty = np.empty(0, np.int64)
    out, base, rows = Plan(size.bit_length(), empty, empty, empty, empty), 0, []
    for pattern in patterns(histogram, size, slack):
        runs = pattern.listed()
        for run, offset in zip(runs, accumulate((r.length for r in runs), initial=0)):
            rows.append((out.key(run.rest, run.cut, run.rank), run.length, base - run.rank, offset))
        base += pattern.count
    return Plan(out.bits, *np.array(sorted(rows), np.int64).reshape(-1, 4).T.copy())


# --- pieces -----------------------------------------------------------------------------------

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, slack: int = SLACK) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every piece of every document and its place.

    ``ids`` are packed little-endian 32-bit integers. Packs have the smaller
    sequence numbers, whole sequences the larger ones, by task and row.
    """
    tokens = tokenized(docs, vocabulary_path, doc_id, text, size, end)
    counts = stored(tokens.filter("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n")))
    histogram = {r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # fewer than ``size`` rows
    shipped = docs.sparkSession.sparkContext.broadcast(plan(histogram, size, slack))
    earlier = F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")  # one row for each task that wrote ids
    ranked = tokens.join(counts.select("part", "rest", earlier.alias("before")), ["part", "rest"], "left")

    def run(batch: pa.RecordBatch):
        total, part, place, whole, before = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6))
        n = total // size
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        full = (row, nth * size, np.full(len(row), size), (part[row] + 1 << TASK_BITS) + whole[row] + nth, np.zeros(len(row), np.int64))
        row, cut, *more = shipped.value.pieces(total % size, np.nan_to_num(before).astype(np.int64) + place)
        row, start, length, sequence, offset = map(np.concatenate, zip(full, (row, n[row] * size + cut, *more)))
        order = np.lexsort((start, row))
        row, start, length, sequence, offset = (x[order] for x in (row, start, length, sequence, offset))
        # The pieces of a row follow each other and leave nothing out, so its ids only get more offsets.
        ids = batch.column(6)
        edges = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        cuts = np.append(edges[row] + 4 * start, edges[-1]).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts.tobytes()), ids.buffers()[2]])
        return [batch.column(0).take(pa.array(row)), start, length, pieces, total[row], sequence, offset]

    return per_batch(ranked.select("doc_id", "doc_tokens", "part", "place", "whole", "before", "ids"), run, _PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
