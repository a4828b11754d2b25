"""Packing, fill-in-the-middle and vector codes against plain versions, on hard rows."""

import functools
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle  # noqa: E402

from macrolake.llm import codebooks, infill, packing  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, awkward white space, clashing names."""
    long = " ".join(f"word{i} of line {i % 97}" + ("\n" if i % 13 == 0 else "") for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " "), (4, "one"), (4, "one"), (None, "no id\nat all\n"), (None, None), (5, "a  b \n c  d\r\n"), (6, "<|endoftext|> in <|endoftext|>text"),
        (7, "ends without a line end\nlast"), (8, "\n\n\n"), (9, "holds <S> a mark\n"), (10, "żółć 日本語\nтекст <\nS> 🙂\n" * 40), (11, long), (11, long), (12, "x" * 5000 + "\n"),
        (13, "\n".join(["the same passage, again and again"] * 900)), (-5, "It's  we'll\tdon't 'tis\n1234567890   end "), (14, " leading\n"), (15, "tail \n "),
    ]
    frame = spark.createDataFrame(rows * 2, "doc_id long, text string").withColumns(
        {"ids": F.lit("clash"), "rest": F.lit(1), "part": F.lit(2), "start": F.lit(3), "form": F.lit("psm"), "output": F.lit("o"), "n": F.lit(0), "label": F.lit(0), "x": F.lit(1)}
    )
    return frame.repartition(3)


# --- packing ------------------------------------------------------------------------------------


@functools.cache
def library():
    found = Tokenizer.from_file(VOCABULARY)
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, packing.END]


def check_pieces(pieces, texts, size=packing.SIZE):
    """Every id of every document lies in one piece, sequences have no gaps; returns padding and tokens."""
    sequences: dict = {}
    whole: dict = {}
    for r in pieces:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole.setdefault(r.doc_id, []).append((r.start, ids.tolist(), r.doc_tokens))
    used = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        used.append(at)
    want: dict = {}
    for doc_id, text in texts:
        want.setdefault(doc_id, []).append(ids_of(text))
    assert set(want) == set(whole)
    for doc_id, documents in want.items():
        # Documents that share an id are told apart by their piece starts: together the pieces hold all ids.
        assert Counter(i for d in documents for i in d) == Counter(i for _, ids, _ in whole[doc_id] for i in ids)
        assert {t for *_, t in whole[doc_id]} == set(map(len, documents))
        if len(documents) == 1:
            joined = [i for _, ids, _ in sorted(whole[doc_id]) for i in ids]
            assert joined == documents[0] and {t for *_, t in whole[doc_id]} == {len(joined)}
    return sum(size - u for u in used if u & (u - 1)), sum(used)


def test_packing_holds_every_id_once(docs):
    pieces = packing.pack(docs, VOCABULARY).collect()
    padding, tokens = check_pieces(pieces, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert padding <= 0.01 * tokens


def test_packing_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.pack(docs.repartition(5), VOCABULARY)
    padding, tokens = check_pieces(pieces.collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert padding <= 0.01 * tokens
    rows = packing.digests(pieces).collect()
    texts = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    for r in rows[:200]:
        assert r.ids_crc32 == zlib.crc32(np.array(texts[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_packing_takes_empty_tables(docs):
    assert packing.digests(packing.pack(docs.limit(0), VOCABULARY)).collect() == []


def test_packing_of_one_common_length(spark):
    """All rests have one length that two of cannot share a sequence, and one row alone."""
    text = " ".join(["the"] * 599)
    same = spark.range(64).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    for frame in (same, same.limit(1)):
        padding, tokens = check_pieces(packing.pack(frame, VOCABULARY).collect(), [(r.doc_id, r.text) for r in frame.collect()])
        assert padding <= 0.01 * tokens


@pytest.mark.parametrize("seed", range(12))
def test_patterns_place_every_rest(seed):
    draw = random.Random(seed)
    size = draw.choice([8, 64, 1024])
    slack = draw.choice([0, 1, size // 128])
    histogram = Counter(min(size - 1, max(1, int(draw.gauss(draw.random() * size, size / 3)))) for _ in range(draw.choice([1, 3, 40, 3000])))
    where = packing.plan(histogram, size, slack)
    rest = np.repeat(np.array(list(histogram), np.int64), list(histogram.values()))
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    row, cut, length, sequence, offset = where.pieces(rest, rank)
    order = np.lexsort((cut, row))
    ends = np.append(row[order][1:] != row[order][:-1], True)
    assert (np.where(ends, rest[row[order]], np.append(cut[order][1:], 0)) == (cut + length)[order]).all()
    order = np.lexsort((offset, sequence))
    sequence, offset, length = sequence[order], offset[order], length[order]
    first = np.append(True, sequence[1:] != sequence[:-1])
    assert (offset[first] == 0).all() and (offset[1:][~first[1:]] == (offset + length)[:-1][~first[1:]]).all()
    used = (offset + length)[np.append(first[1:], True)]
    assert used.max() <= size and sorted(set(sequence.tolist())) == list(range(len(used)))
    assert ((used >= size - slack) | (used & (used - 1) == 0)).all()


def test_patterns_do_not_grow_with_the_counts():
    draw = random.Random(0)
    few = {n: draw.randrange(1, 50) for n in range(1, 1024, 7)}
    many = {n: c * 10**8 + draw.randrange(10**6) for n, c in few.items()}
    assert len(packing.patterns(many)) < 20 * len(packing.patterns(few))


def test_units_equal_the_library():
    draw = random.Random(3)
    encoder = packing.Encoder(VOCABULARY)
    pieces = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "a", "the", "'s", "don't", "12", "3.5", "...", "日本", "ż", "<|endoftext|>", "🙂", "́", "Ġ", "-"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(30))) for _ in range(3000)]
    assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in library().encode_batch(texts, add_special_tokens=False)]


# --- fill in the middle -----------------------------------------------------------------------


def plain_infill(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by lists of lines."""
    import hashlib

    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_a_plain_version(docs):
    rows = infill.rearrange(docs).withColumn("restored", infill.restored()).collect()
    given = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *plain_infill(r.doc_id, r.text), r.text or "") for r in given)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert infill.digests(infill.rearrange(docs.limit(0))).collect() == []


@pytest.mark.parametrize("largest", [100, 1 << 16])
def test_infill_on_random_lines(spark, monkeypatch, largest):
    """Chunks of the largest size, cuts inside chunks, texts with signs that look like parts of marks."""
    import pyarrow as pa

    monkeypatch.setattr(infill, "LARGEST", largest)
    draw = random.Random(largest)
    pieces = ["\n", "<", "P>", "S>", "M>", "ab cd", "żółć", "🙂", "x" * 70, " "]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(400))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(300), pa.int64()), "text": texts})
    memory = infill.Memory(limit=20_000)
    out = infill.rearranged(batch.slice(3), memory).to_pylist()
    assert [tuple(r.values())[1:] for r in out] == [plain_infill(i, texts[i]) for i in range(3, 300)]


def test_chunks_follow_the_content():
    draw = random.Random(5)
    passage = "".join(draw.choices("abcdefgh \n", k=40_000)).encode()
    chunked = []
    for before in (b"", b"another beginning " * 9, b"z" * 1000):
        raw = before + passage
        marks = infill.cut_marks(np.frombuffer(raw, np.uint8))
        ends = infill.chunk_ends(marks, 0, len(raw))
        assert ends[-1] == len(raw)
        chunked.append({raw[a:b] for a, b in zip([0, *ends], ends)})
    assert len(chunked[0] & chunked[1] & chunked[2]) >= 0.8 * len(chunked[0]) > 10
    memory = infill.Memory()
    for chunks in chunked:
        for c in chunks:
            memory.get(c)
    assert memory.hits >= 1.6 * len(chunked[0])


def test_memory_verifies_the_content(monkeypatch):
    monkeypatch.setattr(infill.xxhash, "xxh3_64_intdigest", lambda chunk: 1)
    memory = infill.Memory()
    for chunk in (b"a\nb", b"abc", b"a\nb", "żó\n".encode()):
        got, want = memory.get(chunk), infill.summary(chunk)
        assert got.chars == want.chars and got.line_bytes.tolist() == want.line_bytes.tolist()


# --- vector codes -----------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """{row number: (code, error)} and the codebooks by full search, for rows (vec_id, ints)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = np.array([r[1] for r in rows], np.int64).reshape(len(rows), parts, -1)
    books = x[order[:entries]].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[codes[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    codes, error = assign()
    return [bytes(c.astype(np.uint8).tolist()).hex() for c in codes], error.tolist(), books


@pytest.fixture(scope="module")
def vectors(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([0.0, 0.25, -0.5, draw.gauss(0, 1), draw.gauss(0, 0.01)]) for _ in range(32)], draw.choice([None, 1, 1, 1, 2])) for i in range(300)]
    rows += [rows[7]] * 60 + [(7, rows[8][1], 5), (None, rows[9][1], None)]
    rows += [(400, None, 1), (401, [0.1] * 31 + [None], 1), (402, [0.1] * 31 + [float("nan")], 1), (403, [float("-inf")] + [0.1] * 31, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.withColumns({"x": F.lit(1), "code": F.lit("clash"), "error": F.lit(2), "salt": F.lit(3)}).repartition(4)


def test_codes_equal_a_full_search(vectors):
    given = [(r.vec_id, [int(np.floor(256 * float(c))) for c in r.embedding], r.label) for r in vectors.collect() if r.vec_id is None or r.vec_id < 400]
    codes, error, books = plain_codes(given)
    labels = Counter()
    for (_, _, label), e in zip(given, error):
        labels[label] += e
    found, own = codebooks.compress(vectors)
    assert (own == books).all()
    rows = codebooks.report(found, own).collect()
    want = Counter((v, c, e, labels[label]) for (v, _, label), c, e in zip(given, codes, error))
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in rows) == want
    assert {r.codebooks_sha256 for r in rows} == {codebooks.digest(books)}


def test_codes_of_few_and_no_vectors(vectors):
    few = vectors.filter("vec_id < 3")
    assert {r.code[:2] for r in codebooks.report(*codebooks.compress(few)).collect()} == {"00", "01", "02"}
    assert codebooks.report(*codebooks.compress(vectors.limit(0))).collect() == []
    with pytest.raises(ValueError, match="cannot be cut"):
        codebooks.compress(few.withColumn("embedding", F.slice("embedding", 1, 20)))
    with pytest.raises(ValueError, match="beyond"):
        codebooks.compress(few.withColumn("embedding", F.transform("embedding", lambda c: F.lit(1e9))))


@pytest.mark.parametrize("across", [1, 3, 12, 200])
def test_cells_keep_every_nearest_entry(across):
    draw = np.random.default_rng(across)
    for width in (1, 2, 5):
        entries = draw.integers(-40, 40, (64, width))
        entries[10] = entries[3]  # equal entries: the lower index wins
        points = draw.integers(-60, 60, (500, width))
        search = codebooks.Cells(entries, across, remembered=50)
        for part in np.array_split(points, 7):
            index, distance = search.nearest(part)
            full = ((part[:, None] - entries[None]) ** 2).sum(axis=2)
            assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
        assert search.compared <= 64 * len(points)
        search.corners = search.corners + 1000  # as if other cells had the same hashes
        index, distance = search.nearest(part)
        full = ((part[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_cells_spare_most_comparisons(sf):
    import pyarrow.parquet as pq

    x = np.floor(256 * np.stack(pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")["embedding"].to_numpy()).astype(float)).astype(np.int64).reshape(-1, 16, 4)
    compared = 0
    for p in range(16):
        search = codebooks.Cells(x[:64, p])
        search.nearest(x[:, p])
        compared += search.compared
    assert compared < 0.25 * 64 * 16 * len(x)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_vector_codes"])
def test_same_rows_as_sql_on_the_larger_table(spark, name):
    from macrolake.llm import queries

    problems, n = oracle.differences(spark, oracle.connect("/root/testdata/sf0.01"), queries.QUERIES[name], queries.ORACLE_SQL[name], "/root/testdata/sf0.01")
    assert problems == [] and n > 0
