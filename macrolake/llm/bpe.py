"""Byte-level BPE with a minimal acyclic transducer of frequent words.

The word counts of the whole corpus give the frequent words. Their ids come
from exact merging, once, on the driver; sorted, they are compiled into a
minimal acyclic automaton in one pass (equal suffixes become one state, after
Daciuk et al. 2000). Each transition carries a number, the sum along a word's
path is the word's rank, and the rank finds its ids in a table. The automaton
is laid out in flat arrays in one file, which Spark's file distribution brings
to every executor and which workers map into memory, so that all workers of a
machine share the pages. A batch's distinct words walk it together, one byte
each step, in numpy. Words that it does not hold are merged exactly.

A unit of lookup is the text between two single spaces that stand between
other characters: no pre-token crosses such a boundary. Strings of added
tokens inside a text become their ids, as in the tokenizers library.

Rows: a null text is empty, an empty text has no ids. Every input row gives one
row. Bytes that are no valid UTF-8 after decoding become U+FFFD.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import tempfile
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.llm.common import per_batch, text_of

#: Most words of the lexicon, and how often a word must stand in the corpus to enter it.
LEXICON_WORDS, LEXICON_COUNT = 60_000, 16
#: Words that a worker remembers beside the lexicon before it starts anew.
REMEMBERED = 300_000
#: Bytes from which a pre-token is merged by a heap.
LONG = 64

_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_OTHER = _SPACE.replace("[", "[^", 1)
#: Fixed: the pre-token pattern of byte-level BPE.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?(?:(?!\p{L}|\p{N})" + _OTHER + ")+|" + _SPACE + "+(?!" + _OTHER + ")|" + _SPACE + "+"
)
_BOUNDARY = regex.compile("(?<=" + _OTHER + ") (?=" + _OTHER + ")")


def byte_letters() -> dict[str, int]:
    """The byte of each letter in a vocabulary file: printable bytes stand for themselves, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A vocabulary file: merge ranks, ids, bytes of ids, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in piece): i for piece, i in data["model"]["vocab"].items() if all(c in letters for c in piece)}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        raw = lambda piece: bytes(letters[c] for c in piece)
        #: The rank of a pair of ids, as one number, and the id each rank makes.
        self.ranks = {self.ids[raw(a)] << 20 | self.ids[raw(b)]: i for i, (a, b) in enumerate(pairs)}
        self.made = [self.ids[raw(a) + raw(b)] for a, b in pairs]
        self.of_byte = [self.ids.get(bytes([b]), -1) for b in range(256)]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*data["model"]["vocab"].values(), *self.added.values()]) + 1
        self.bytes = [b""] * size
        for piece, i in self.ids.items():
            self.bytes[i] = piece
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        #: The same ranks for lookups of whole arrays; the last entry is larger than any pair.
        order = np.array(sorted(self.ranks), np.int64)
        self.pair_keys = np.append(order, np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([self.ranks[k] for k in order.tolist()], np.int64), len(self.made))
        self.made_ids = np.array(self.made, np.int64)
        self.byte_ids = np.array(self.of_byte, np.int64)
        self.pattern = regex.compile(PRE_TOKEN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank is merged, leftmost first, until none is left."""
        never = len(self.made)
        get = self.ranks.get
        ids = [self.of_byte[b] for b in token]
        ranks = [get(a << 20 | b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            ids[i : i + 2] = [self.made[best]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], never)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], never)
        return ids

    def merge_long(self, token: bytes) -> list[int]:
        """As merge(), by a heap over a linked list, for long pre-tokens."""
        n = len(token)
        ids = [self.of_byte[b] for b in token]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.ranks.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := self.ranks.get(ids[k] << 20 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return [x for x in ids if x >= 0]

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, the number of merges where there is none."""
        pairs = left << 20 | right
        at = np.searchsorted(self.pair_keys, pairs)
        return np.where(self.pair_keys[at] == pairs, self.pair_ranks[at], len(self.made))

    def merge_all(self, tokens: list[bytes]) -> list[bytes]:
        """As merge() for many pre-tokens at once, packed; each round merges one pair of every token that has one left."""
        never = len(self.made)
        out = [b""] * len(tokens)
        short = [i for i, t in enumerate(tokens) if 0 < len(t) < LONG]
        for i, t in enumerate(tokens):
            if len(t) >= LONG:
                out[i] = np.array(self.merge_long(t), "<u4").tobytes()
        lengths = np.fromiter((len(tokens[i]) for i in short), np.int64, len(short))
        token = np.array(short, np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join([tokens[i] for i in short]), np.uint8)]
        last = np.zeros(len(ids), bool)
        last[np.cumsum(lengths) - 1] = True
        ranks = np.full(len(ids), never, np.int64)
        inner = np.flatnonzero(~last)
        ranks[inner] = self.pair_rank(ids[inner], ids[inner + 1])
        while len(ids):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(ranks, starts)
            done = best == never
            if done.any():
                gone = np.repeat(done, lengths)
                packed, at = ids[gone].astype("<u4").tobytes(), 0
                for i, n in zip(token[done].tolist(), lengths[done].tolist()):
                    out[i] = packed[at : at + 4 * n]
                    at += 4 * n
                token, lengths, best = token[~done], lengths[~done], best[~done]
                ids, last, ranks = ids[~gone], last[~gone], ranks[~gone]
                if not len(ids):
                    break
            # The leftmost of a token's pairs of lowest rank.
            owner = np.repeat(np.arange(len(lengths)), lengths)
            hits = np.flatnonzero(ranks == best[owner])
            at = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]
            ids[at] = self.made_ids[best]
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # every earlier token has lost one symbol
            ids, last, ranks = ids[keep], last[keep], ranks[keep]
            lengths = lengths - 1
            ranks[at] = never
            inner = at[~last[at]]
            ranks[inner] = self.pair_rank(ids[inner], ids[inner + 1])
            before = at[at > 0] - 1
            before = before[~last[before]]
            ranks[before] = self.pair_rank(ids[before], ids[before + 1])
        return out

    def encode_units(self, units: list[str]) -> dict[str, bytes]:
        """Packed ids of each unit with a space before it; equal pre-tokens are merged once, units of letters are one."""
        words = [u for u in units if u.isascii() and u.isalpha()]
        cut = {u: self.pattern.findall(" " + u) for u in set(units).difference(words)}
        tokens = list(set(map(" ".__add__, words)).union(*cut.values()))
        ids = dict(zip(tokens, self.merge_all([t.encode("utf-8") for t in tokens])))
        packed = {u: ids[" " + u] for u in words}
        packed.update((u, b"".join(map(ids.__getitem__, c))) for u, c in cut.items())
        return packed

    def encode(self, text: str) -> list[int]:
        """The ids of a piece of text without added tokens."""
        ids: list[int] = []
        for token in self.pattern.findall(text):
            raw = token.encode("utf-8")
            ids += self.merge(raw) if len(raw) < LONG else self.merge_long(raw)
        return ids


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Flat arrays of the minimal acyclic transducer of sorted distinct words; the numbers along a path sum to the word's rank."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]  # open states of the last word: is final, transitions to finished states

    def close(down_to: int, last: bytes) -> None:
        while len(path) > down_to + 1:
            final, moves = path.pop()
            key = (final, tuple(moves))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1].append((last[len(path) - 1], register[key]))

    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        close(common, last)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        last = word
    close(0, last)
    states.append((path[0][0], tuple(path[0][1])))
    below = np.zeros(len(states), np.int64)  # words that a state accepts; targets are closed before their sources
    for i, (final, moves) in enumerate(states):
        below[i] = final + sum(below[to] for _, to in moves)
    first = np.zeros(len(states) + 1, np.int64)
    label, target, number = [], [], []
    for i, (final, moves) in enumerate(states):
        so_far = int(final)
        for byte, to in moves:
            label.append(i * 256 + byte)
            target.append(to)
            number.append(so_far)
            so_far += int(below[to])
        first[i + 1] = len(label)
    return {
        "moves": np.array(label, np.int64),
        "targets": np.array(target, np.int64),
        "numbers": np.array(number, np.int64),
        "finals": np.array([f for f, _ in states], np.int64),
        "root": np.array([len(states) - 1], np.int64),
    }


class Lexicon:
    """The automaton and the id table of a file, mapped into memory."""

    NAMES = ("moves", "targets", "numbers", "finals", "root", "starts", "ids")

    @staticmethod
    def write(path: str, words: dict[bytes, list[int]]) -> None:
        ordered = sorted(words)
        parts = minimal_automaton(ordered)
        parts["starts"] = np.cumsum([0, *(len(words[w]) for w in ordered)]).astype(np.int64)
        parts["ids"] = np.array([i for w in ordered for i in words[w]], np.int64)
        with open(path, "wb") as file:
            file.write(np.array([len(parts[n]) for n in Lexicon.NAMES], np.int64).tobytes())
            for n in Lexicon.NAMES:
                file.write(parts[n].tobytes())

    def __init__(self, path: str):
        with open(path, "rb") as file:
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        lengths = np.frombuffer(mapped, np.int64, len(self.NAMES))
        at = 8 * len(self.NAMES)
        for name, n in zip(self.NAMES, lengths.tolist()):
            setattr(self, name, np.frombuffer(mapped, np.int64, n, at))
            at += 8 * n

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 without one; all words walk together, a byte each step."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.moves):
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        alive = np.arange(len(words))
        state = np.full(len(words), self.root[0])
        rank = np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            over = lengths[alive] == step
            ended = alive[over]
            out[ended] = np.where(self.finals[state[over]] == 1, rank[over], -1)
            alive, state, rank = alive[~over], state[~over], rank[~over]
            move = state * 256 + text[begin[alive] + step]
            at = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
            known = self.moves[at] == move
            alive, state, rank = alive[known], self.targets[at[known]], rank[known] + self.numbers[at[known]]
            step += 1
        return out

    def packed(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian 32-bit integers; None if the lexicon does not hold it."""
        ids = self.ids.astype("<u4")
        return [None if r < 0 else ids[self.starts[r] : self.starts[r + 1]].tobytes() for r in self.ranks(words).tolist()]


class Encoder:
    """Encodes and decodes texts in one worker."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str, bytes | None] = {}

    def learn(self, units: list[str]) -> None:
        """Remember the ids of units that a space precedes; None marks a unit whose neighbours matter."""
        clear = []
        for unit in units:
            if not unit or unit[0].isspace() or unit[-1].isspace():
                self.known[unit] = None
            else:
                clear.append(unit)
        raw = [b" " + u.encode("utf-8") for u in clear]
        found = self.lexicon.packed(raw) if self.lexicon and raw else [None] * len(raw)
        self.known.update(zip(clear, found))
        self.known.update(self.vocabulary.encode_units([u for u, ids in zip(clear, found) if ids is None]))

    def pack(self, text: str) -> bytes:
        return np.array(self.vocabulary.encode(text), "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        units = text.split(" ")
        head, rest = units[0], units[1:]
        try:
            if head and not head[-1].isspace():
                return self.pack(head) + b"".join(map(self.known.__getitem__, rest))
        except TypeError:
            pass
        cut = _BOUNDARY.split(text)
        return b"".join([self.pack(cut[0]), *(self.pack(" " + u) for u in cut[1:])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        pieces = [self.vocabulary.specials.split(t) if self.vocabulary.specials and self.vocabulary.specials.search(t) else (t,) for t in texts]
        units: set[str] = set()
        for cut in pieces:
            for t in cut:
                units.update(t.split(" ")[1:])
        if len(units) > REMEMBERED and len(texts) > 1:
            half = len(texts) // 2
            return self.encode(texts[:half]) + self.encode(texts[half:])
        new = units.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:  # what these texts need is learned whole, even if that is more
            self.known.clear()
            new = units
        self.learn(list(new))
        out = []
        for text, cut in zip(texts, pieces):
            if len(cut) == 1:
                out.append(self.piece(text) if text else b"")
            else:
                found = [np.array([self.vocabulary.added[m]], "<u4").tobytes() for m in self.vocabulary.specials.findall(text)]
                ids = [self.piece(c) if c else b"" for c in cut]
                out.append(b"".join(x for pair in zip(ids, [*found, b""]) for x in pair))
        return out

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids, in UTF-8."""
        raw = b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode("utf-8")


def word_counts(docs: DataFrame, text: str = "text", least: int = LEXICON_COUNT) -> DataFrame:
    """(unit, n): how often each unit of lookup with a space before it stands in the whole corpus."""

    def run(batch: pa.RecordBatch):
        counts: Counter[str] = Counter()
        for t in batch.column(0).to_pylist():
            counts.update(t.split(" ")[1:])
        return [list(counts.keys()), list(counts.values())]

    partial = per_batch(docs.select(text_of(text).alias("text")), run, "unit string, n long")
    return partial.groupBy("unit").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = LEXICON_WORDS, least: int = LEXICON_COUNT) -> str:
    """Compile the frequent words and ship the file to the executors; returns its name. ``words`` bounds what the driver gets."""
    top = word_counts(docs, text, least).orderBy(F.desc("n"), "unit").limit(words).select("unit").collect()
    chosen = [r.unit for r in top if r.unit and not r.unit[0].isspace() and not r.unit[-1].isspace()]
    if vocabulary.specials:
        chosen = [u for u in chosen if not vocabulary.specials.search(u)]
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="lexicon-")), name)
    Lexicon.write(path, {b" " + u.encode("utf-8"): vocabulary.encode(" " + u) for u in chosen})
    docs.sparkSession.sparkContext.addFile(path)
    return name


_WORKER: dict[tuple[str, str], Encoder] = {}


def worker_encoder(vocabulary_file: str, lexicon_file: str) -> Encoder:
    """This worker's encoder; it keeps the one of the last lexicon."""
    key = (vocabulary_file, lexicon_file)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(Vocabulary(SparkFiles.get(vocabulary_file)), Lexicon(SparkFiles.get(lexicon_file)))
    return _WORKER[key]


def ship_vocabulary(spark: SparkSession, path: str) -> str:
    """Bring the vocabulary file to the executors; returns its name."""
    spark.sparkContext.addFile(os.path.realpath(path))
    return os.path.basename(os.path.realpath(path))


def encode_documents(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text", words: int = LEXICON_WORDS, least: int = LEXICON_COUNT) -> DataFrame:
    """(doc_id, ids, decoded): packed little-endian 32-bit ids of the whole text, and the UTF-8 text decoded from them."""
    vocabulary_file = ship_vocabulary(docs.sparkSession, vocabulary_path)
    lexicon_file = build_lexicon(docs, Vocabulary(vocabulary_path), text, words, least)

    def run(batch: pa.RecordBatch):
        encoder = worker_encoder(vocabulary_file, lexicon_file)
        ids = encoder.encode(batch.column(1).to_pylist())
        return [batch.column(0), ids, [encoder.decode(x) for x in ids]]

    return per_batch(docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")), run, "doc_id long, ids binary, decoded binary")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and the columns ``more``."""
    return encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) / 4 AS LONG)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
