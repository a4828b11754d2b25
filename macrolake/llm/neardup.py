"""Near-duplicate groups by fast similarity sketching.

A document's set holds the hashes of its distinct 5-word shingles. A sketch has
``COORDINATES`` bins. In round ``i < COORDINATES`` every element is thrown into
a pseudo-random bin with the value ``(i, hash)``, in the later rounds all go to
bin ``i - COORDINATES``; each bin keeps its smallest value and a document stops
once all bins are full, so at the latest after twice as many rounds
(Dahlgaard, Knudsen and Thorup 2017). Groups of ``ROWS`` coordinates are bands.

Documents with equal sets are one node. Nodes that share a band are candidates,
but no bucket is expanded into pairs: its smallest node, its leader, is compared
with the others. What that does not connect is keyed anew by longer bands of a
larger, independent sketch, which documents well below the threshold rarely
share; ``LEADERS`` more rounds of one leader for each bucket connect what can be
connected, then all pairs of a bucket that are in different components are
compared, if their sizes and their signatures of ``BITS`` bits allow the
similarity. Every link is confirmed on the full sets.

Links are found with the probability of a shared band: one at 0.85 is missed by
the long bands with probability 0.004, one at 0.87 with 0.00004. The signatures add
3e-6. A component is lost only if all its links are. Documents at
just below the threshold are compared: n of them that are all pairwise near it
cost a share of n squared over two comparisons, which no banding avoids.

Rows: a null or blank text has an empty set, is linked with nothing and is its
own group. A null ``doc_id`` is a group of its own with a null component.
Repeated rows are equal sets. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import Scratch, per_batch, stored, text_of

WIDTH = 5
#: 36 bands of 5: a pair of similarity 0.85 is missed with probability 7e-10, one of 0.8 with 6e-7.
BANDS, ROWS = 36, 5
COORDINATES = BANDS * ROWS
#: Long bands, and the probability that a pair at the threshold shares a given one, which sets their length: 21 rows for 0.85.
LONG_BANDS, LONG_SHARE = 165, 0.033
#: Rounds of one leader for each long bucket.
LEADERS = 2
#: Bits of a signature, and standard deviations below the expected agreement at which a pair is left out.
BITS, DEVIATIONS = 1024, 4.5
#: Shingles that are sketched at once.
CHUNK = 400_000

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles; ASCII letters lower-cased, words split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(len(words), width)
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(_GOLDEN) + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def sketch(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values for each non-empty set."""
    t = coordinates
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    empty = np.uint64(_MASK)
    bins = np.full(len(sets) * t, empty, np.uint64)
    for i in range(2 * t):
        x = mix(elements ^ mix(np.full(1, ((i + 1) * _GOLDEN) & _MASK, np.uint64)))
        into = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.uint64(i - t)
        np.minimum.at(bins, owner * t + into.astype(np.int64), (x & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32))
        if (i + 1) % max(1, t // 256):  # a look at all bins costs more than a round; later rounds change no full bin
            continue
        open_ = (bins.reshape(-1, t) == empty).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        owner, elements = owner[keep], elements[keep]
    return bins.reshape(-1, t)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hashes of the bands, different for each position."""
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN)), (len(values), bands))
    for r in range(rows):
        keys = mix(keys * np.uint64(_GOLDEN) + values[:, r::rows])
    return keys


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, bands): set size, 128-bit fingerprint of the set, packed band keys."""

    def run(batch: pa.RecordBatch):
        sets = [shingle_set(x) for x in batch.column(1).to_pylist()]
        packed: list[bytes | None] = [None] * len(sets)
        full = [i for i, s in enumerate(sets) if len(s)]
        while full:
            part, size = [], 0
            while full and (not part or size + len(sets[full[-1]]) <= CHUNK):
                part.append(full.pop())
                size += len(sets[part[-1]])
            keys = band_keys(sketch([sets[i] for i in part], bands * rows), bands, rows)
            for i, k in zip(part, keys):
                packed[i] = k.tobytes()
        prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        both = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
        return [batch.column(0), np.array([len(s) for s in sets], np.int64), both[:, 0].copy(), both[:, 1].copy(), packed]

    return per_batch(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")),
        run,
        "doc_id long, n_shingles long, hi long, lo long, bands binary",
    )


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, rep, n): one row for each band of each node."""

    def run(batch: pa.RecordBatch):
        keys = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        counts = [len(k) for k in keys]
        return [np.concatenate(keys)] + [np.repeat(batch.column(i).to_numpy(), counts) for i in (0, 1)]

    return per_batch(nodes.select("rep", "n", "bands"), run, "key long, rep long, n long")


def shared_keys(members: DataFrame) -> DataFrame:
    """The members whose key at least two nodes have."""
    keys = members.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    return members.join(keys, "key", "left_semi")


def full_sets(docs: DataFrame, reps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rep, shingles): the packed sorted set of each listed document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("rep"), text_of(text).alias("text")).join(reps, "rep", "left_semi")
    return per_batch(
        rows, lambda batch: [batch.column(0), [shingle_set(x).tobytes() for x in batch.column(1).to_pylist()]], "rep long, shingles binary"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs (a, b) with ``100 * intersection >= percent * union`` on the full sets."""
    rows = pairs.join(sets.selectExpr("rep AS b", "shingles AS set_b"), "b").join(sets.selectExpr("rep AS a", "shingles AS set_a"), "a")

    def run(batch: pa.RecordBatch):
        last, left, linked = None, None, []
        a, b, set_a, set_b = (batch.column(i) for i in range(4))
        for i in range(batch.num_rows):
            if a[i].as_py() != last:
                last, left = a[i].as_py(), np.frombuffer(set_a[i].as_py(), np.uint64)
            right = np.frombuffer(set_b[i].as_py(), np.uint64)
            at = np.searchsorted(left, right)
            at[at == len(left)] = 0
            both = int((left[at] == right).sum()) if len(left) else 0
            linked.append(100 * both >= percent * (len(left) + len(right) - both))
        keep = pa.array(linked, pa.bool_())
        return [a.filter(keep), b.filter(keep)]

    return per_batch(rows.select("a", "b", "set_a", "set_b"), run, "u long, v long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, component): smallest reachable id for each id of the edges (u, v), by alternating large and small stars; stored in ``scratch``."""
    spark = edges.sparkSession
    last = Scratch(spark)
    now = last.stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v AS u", "m AS v").union(low.select("u", "m")).filter("u <> v").distinct()
        following = Scratch(spark)
        now = following.stored(small)
        last.clear()
        last = following
        sums = now.agg(F.count("*"), F.sum(F.expr("CAST(xxhash64(u, v) AS DECIMAL(38, 0))"))).first()
        if tuple(sums) == state:
            scratch.paths += last.paths
            return now.select(F.col("u").alias("rep"), F.col("v").alias("component"))
        state = tuple(sums)


def fits(percent: int):
    """Sets of such sizes can be similar enough."""
    return F.expr(f"100 * least(n, leader_n) >= {percent} * greatest(n, leader_n)")


def unsettled(members: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of buckets that hold more than one component, with their components; stored."""
    current = members.join(components(edges, scratch), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    spread = current.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    return scratch.stored(current.join(spread, "key", "left_semi"))


def compared(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The confirmed links among pairs (rep, leader); stored."""
    ordered = pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    return scratch.stored(confirmed(ordered, sets, percent))


def led(current: DataFrame, percent: int, salt: int) -> DataFrame:
    """The pairs of each bucket's leader, the smallest under a salted hash, with the members of other components."""
    heads = current.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", F.lit(salt)).alias("h") if salt else F.lit(0).alias("h"), "rep", "n", "component")).alias("head"))
    leaders = heads.selectExpr("key", "head.rep AS leader", "head.n AS leader_n", "head.component AS leader_component")
    return current.join(leaders, "key").filter("component <> leader_component").filter(fits(percent))


def long_sketches(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, n, bands, signature): packed keys of the long bands and a signature for each set."""
    rows = min(32, round(math.log(LONG_SHARE) / math.log(percent / 100))) if percent < 100 else 32
    coordinates = max(LONG_BANDS * rows, BITS)

    def run(batch: pa.RecordBatch):
        fresh = np.uint64(0x5851F42D4C957F2D)
        all_ = [np.frombuffer(x, np.uint64) ^ fresh for x in batch.column(1).to_pylist()]
        keys, signatures, step = [], [], max(1, 2_000_000 // coordinates)
        for at in range(0, len(all_), step):
            values = sketch(all_[at : at + step], coordinates)
            keys += [k.tobytes() for k in band_keys(values[:, : LONG_BANDS * rows], LONG_BANDS, rows)]
            bits = (mix(values[:, :BITS].copy()) & np.uint64(1)).astype(np.uint8)
            signatures += [x.tobytes() for x in np.packbits(bits, axis=1)]
        return [batch.column(0), np.array([len(x) for x in all_]), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]

    return per_batch(sets.select("rep", "shingles"), run, "rep long, n long, bands binary, signature binary")


def alike(percent: int):
    """Signatures agree often enough for the similarity, but for chance."""
    agree = (1 + percent / 100) / 2
    least = BITS * agree - DEVIATIONS * math.sqrt(BITS * agree * (1 - agree))
    # A signature is compared as so many 64-bit numbers.
    words = " + ".join(f"bit_count(s{i} ^ t{i})" for i in range(BITS // 64))
    return F.expr(f"{words} <= {int(BITS - least)}")


def later_rounds(nodes: DataFrame, sets: DataFrame, percent: int, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The links among ``nodes`` (rep) that ``edges`` does not imply, and ``edges``."""
    sketched = scratch.stored(long_sketches(sets.join(nodes, "rep", "left_semi"), percent))
    shared = scratch.stored(shared_keys(bucket_rows(sketched)).distinct())
    for salt in range(1, LEADERS + 1):
        current = unsettled(shared, edges, scratch)
        if current.isEmpty():
            return edges
        found = compared(led(current, percent, salt), sets, percent, scratch)
        if not found.isEmpty():
            edges = scratch.stored(edges.union(found))
    current = unsettled(shared, edges, scratch)
    if current.isEmpty():
        return edges
    words = [F.expr(f"CAST(conv(hex(substring(signature, {8 * i + 1}, 8)), 16, -10) AS BIGINT)") for i in range(BITS // 64)]
    signed = sketched.select("rep", *[w.alias(f"s{i}") for i, w in enumerate(words)])
    numbered = scratch.stored(current.join(signed, "rep").select("key", "rep", "n", "component", *signed.columns[1:]))
    renamed = [F.col(c).alias(f"leader{x}") for c, x in (("rep", ""), ("n", "_n"), ("component", "_component"))]
    others = numbered.select("key", *renamed, *[F.col(f"s{i}").alias(f"t{i}") for i in range(BITS // 64)])
    apart = F.expr("rep < leader AND component <> leader_component")
    pairs = numbered.join(others, "key").filter(apart).filter(fits(percent)).filter(alike(percent))
    return scratch.stored(edges.union(compared(pairs, sets, percent, scratch)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    all_ = stored(sketches(docs, doc_id, text, bands, rows))
    some = all_.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = stored(some.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")))
    nodes = some.join(reps.select("hi", "lo", F.col("rep").alias("doc_id")), ["hi", "lo", "doc_id"], "left_semi")
    nodes = nodes.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands")
    members = scratch.stored(shared_keys(bucket_rows(nodes)).distinct())
    sets = scratch.stored(full_sets(docs, members.select("rep").distinct(), doc_id, text))
    edges = compared(led(members.withColumn("component", F.col("rep")), percent, 0), sets, percent, scratch)
    left = unsettled(members, edges, scratch)
    if not left.isEmpty():
        edges = later_rounds(left.select("rep").distinct(), sets, percent, edges, scratch)
    groups = reps.join(components(edges, scratch), "rep", "left").select("hi", "lo", F.coalesce("component", "rep").alias("component_id"))
    groups = stored(groups)
    scratch.clear()
    return (
        all_.select("doc_id", "n_shingles", "hi", "lo")
        .join(groups.select("hi", "lo", "component_id"), ["hi", "lo"], "left")
        .withColumn("component_id", F.when(F.expr("n_shingles = 0 OR doc_id IS NULL"), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )
