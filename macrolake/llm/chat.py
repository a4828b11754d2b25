"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a
backslash goes between ``<`` and ``|`` (one more if backslashes already stand
there), so no control string can arise from a text and the change can be taken
back; in roles, line feeds and backslashes are escaped as well.

The rows are partitioned by ranges of conversation, turn, role and the beginning
of the text and sorted, so a hot conversation is laid out by several tasks; they
go through as a stream: a batch's turns are laid out in one step. Segment
lengths of headers, contents and ends give cumulative offsets, numpy
scatters all bytes into one preallocated buffer, and that buffer is the data of
the resulting Arrow column. A conversation that spans batches or tasks becomes
several parts, in the order of their numbers, so memory stays bounded whatever
its length. Reading back, a conversation that lies whole inside a task is digested
there; only those at the ends of a task, and very long ones, are brought together,
since a digest must see all of a conversation in order.

Rows: a null text is empty, a null role is an empty role. Rows without a
``conv_id`` form one conversation with a null id. Turns with equal numbers
(null first) are ordered by role and text; repeated rows stay, and those alike in
all of the partitioning meet in one task, as a stream. Other columns
are not read. An empty table gives no parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import BATCH_BYTES, bounded_batches

START, END = b"<|im_start|>", b"<|im_end|>\n"
#: The role whose texts are trained on.
LOSS_ROLE = "assistant"

#: Code points of the text that the partitioning looks at.
BEGINNING = 32
#: Parts of a conversation in one task have numbers below two to this power, above which stands the task's.
PART_BITS = 33

_PARTS = "conv_id long, part long, formatted string, loss_starts array<long>, loss_lengths array<long>"
_SAID = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
_BOTH = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())), ("loss_lengths", pa.list_(pa.int64())), *list(_READ)[1:],
    ]
)


def escape_role(role: str) -> bytes:
    """The header of a turn."""
    safe = role.replace("\\", "\\\\").replace("\n", "\\n")
    return START + re.sub(r"<(\\*)\|", r"<\\\1|", safe).encode("utf-8") + b"\n"


def unescape(raw: bytes) -> bytes:
    return re.sub(rb"<\\(\\*)\|", rb"<\1|", raw) if b"<\\" in raw else raw


def unescape_role(raw: bytes) -> bytes:
    return re.sub(rb"\\(n|\\)", lambda m: b"\n" if m[1] == b"n" else b"\\", unescape(raw))


def escape_texts(texts: pa.Array) -> pa.Array:
    """Texts with their control strings broken; batches without any are left as they are."""
    if not pc.any(pc.match_substring(texts, "<")).as_py():
        return texts
    return pc.replace_substring_regex(texts, pattern=r"<(\\*)\|", replacement=r"<\\\1|")


def scatter(out: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, to: np.ndarray) -> None:
    """Copy the pieces ``data[starts : starts + lengths]`` to the places ``to``."""
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[within + np.repeat(to, lengths)] = data[within + np.repeat(starts, lengths)]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns; the starts of the turns (one more than turns), and starts and lengths of the texts."""
    n = len(texts)
    coded = roles.dictionary_encode()
    names = [escape_role(r) for r in coded.dictionary.to_pylist()]
    which = coded.indices.to_numpy(zero_copy_only=False)
    name_lengths = np.array([len(x) for x in names], np.int64)
    name_starts = np.cumsum(name_lengths) - name_lengths
    texts = pa.concat_arrays([escape_texts(texts).cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lengths = np.column_stack([name_lengths[which], np.diff(offsets), np.full(n, len(END))])
    places = np.concatenate([[0], np.cumsum(lengths)])
    begin = places[:-1].reshape(n, 3)
    out = np.empty(places[-1], np.uint8)
    scatter(out, np.frombuffer(b"".join(names), np.uint8), name_starts[which], lengths[:, 0], begin[:, 0])
    scatter(out, body, offsets[:-1], lengths[:, 1], begin[:, 1])
    out[begin[:, 2][:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, np.concatenate([begin[:, 0], places[-1:]]), begin[:, 1], lengths[:, 1]


def format_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations from their sorted rows."""
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << PART_BITS
    last, part = object(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_pylist()
        roles, texts = batch.column(1), batch.column(2)
        out, turns, text_at, text_length = assemble(roles, texts)
        first = [i for i in range(len(conv)) if not i or conv[i] != conv[i - 1]]
        stop = [*first[1:], len(conv)]
        parts = []
        for i in first:
            part = part + 1 if conv[i] == last else base
            parts.append(part)
            last = conv[i]
        trained = pc.equal(roles, LOSS_ROLE).to_numpy(zero_copy_only=False)
        spans = [np.flatnonzero(trained[a:b]) + a for a, b in zip(first, stop)]
        places = turns[[*first, len(conv)]]
        formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(out))
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": pa.array([conv[i] for i in first], pa.int64()),
                "part": pa.array(parts, pa.int64()),
                "formatted": formatted.cast(pa.string()),
                "loss_starts": pa.array([text_at[s] - turns[i] for s, i in zip(spans, first)], pa.list_(pa.int64())),
                "loss_lengths": pa.array([text_length[s] for s in spans], pa.list_(pa.int64())),
            }
        )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss_starts, loss_lengths): formatted text and the byte spans under the loss mask.

    The parts of a conversation come one after another in each partition, partitions in order; ``part`` ascends, with gaps.
    """
    bounded_batches(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("turn").alias("turn"),
    )
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, BEGINNING))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(format_stream, _PARTS)


class Said:
    """Reads the parts of one conversation in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, part: dict) -> None:
        raw = part["formatted"].encode("utf-8")
        for turn in raw.split(START)[1:]:
            role, text = turn.split(b"\n", 1)
            self.turns += 1
            self.said.update(unescape_role(role) + b"\n" + unescape(text[: -len(END)]) + b"\n")
        for at, n in zip(part["loss_starts"], part["loss_lengths"]):
            text = unescape(raw[at : at + n])
            self.loss_chars += len(text.decode("utf-8"))
            self.loss.update(text)
        self.chars += len(part["formatted"])

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }


def read_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the conversations that lie inside the stream; of the first, the last and very long ones the parts as they are."""
    now, held, size, apart = None, [], 0, True
    for batch in batches:
        out = []
        for part in batch.to_pylist():
            if now is not None and part["conv_id"] != now[0]:
                if held:
                    said = Said(now[0])
                    for x in held:
                        said.add(x)
                    out.append(said.row())
                held, size, apart = [], 0, False
            now = (part["conv_id"],)
            held.append(part)
            size += len(part["formatted"])
            if apart or size > BATCH_BYTES:
                out, held, apart = out + held, [], True
        if out:
            yield pa.RecordBatch.from_pylist(out, _BOTH)
    if held:
        yield pa.RecordBatch.from_pylist(held, _BOTH)


def read_ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of read_inside(), sorted, with the parts of each conversation read in order."""
    said = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if said and (row["formatted"] is None or row["conv_id"] != said.conv_id):
                out.append(said.row())
                said = None
            if row["formatted"] is None:
                out.append(row)
            else:
                said = said or Said(row["conv_id"])
                said.add(row)
        if out:
            yield pa.RecordBatch.from_pylist([{name: x[name] for name in _READ.names} for x in out], _READ)
    if said:
        yield pa.RecordBatch.from_pylist([said.row()], _READ)


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted parts say, per conversation; they must come as format_conversations() gives them."""
    both = parts.mapInArrow(read_inside, f"{_PARTS}, {_SAID}")
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(read_ordered, f"conv_id long, {_SAID}")
