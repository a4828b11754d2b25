"""Exact top-k by inner product, in the three phases of a uniform threshold.

The dimensions are cut into ``LISTS`` parts; a vector's score is the sum of its
part scores. Queries and vectors are packed into blocks, and every block of
queries meets every block of vectors once in a phase.

1. Each meeting takes the best ``k`` of every part list and their whole scores.
   The k-th best whole score of a query over all blocks is its cutoff: at least
   ``k`` rows reach it.
2. The cutoffs travel back with the query blocks. A row that reaches the
   cutoff c has a part score of at least c / LISTS, so all others drop out.
3. The rows that are left get their whole scores, and those that reach the
   cutoff are ranked.

Rows: a vector that is null, empty, or holds a null, NaN or infinite component
takes no part, nor does a row without an id. Vectors meet those of the same
length only. Repeated rows are candidates each; of query rows with one id the
smallest vector asks. A row with the query's id is never its answer. Scores
outside 64 bits are held at the end of the range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import bounded_batches, per_batch, stored

#: Parts of a score.
LISTS = 4
#: Vectors and queries of a block at most.
VECTOR_ROWS, QUERY_ROWS = 4096, 512
_EXACT = 2.0**53


def usable(frame: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, e): rows that take part."""
    finite = f"id IS NOT NULL AND size(e) > 0 AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = frame.select(F.col(vec_id).cast("long").alias("id"), F.expr(f"CAST({vector} AS ARRAY<DOUBLE>)").alias("e")).filter(finite)
    return rows.select("id", "e")


def packed(rows: DataFrame, most: int, scale: int) -> DataFrame:
    """(block, dim, ids, matrix): up to ``most`` rows of one length in a block; stored, so that ``block`` is a stable name."""
    bounded_batches(rows.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            column = batch.column(1)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                with np.errstate(over="ignore"):
                    matrix = np.floor(flat[(ends[at] - dim)[:, None] + np.arange(dim)] * scale)
                matrix = np.clip(matrix, -np.finfo(float).max, np.finfo(float).max)
                for i in range(0, len(at), most):
                    yield pa.RecordBatch.from_pydict(
                        {"dim": pa.array([int(dim)], pa.int64()), "ids": [ids[at[i : i + most]].tobytes()], "matrix": [matrix[i : i + most].tobytes()]}
                    )

    blocks = rows.mapInArrow(run, "dim long, ids binary, matrix binary")
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()))


def part_scores(queries: np.ndarray, vectors: np.ndarray, lists: int) -> list[np.ndarray]:
    """The part scores, exactly: in doubles where whole numbers fit, else in Python's."""
    cuts = np.linspace(0, queries.shape[1], lists + 1).astype(int)
    most = np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1]
    if not most < _EXACT:
        whole = np.vectorize(int, otypes=[object])
        queries, vectors = whole(queries), whole(vectors)
    return [queries[:, a:b] @ vectors[:, a:b].T for a, b in zip(cuts, cuts[1:]) if a < b]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def top_k(frame: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the best ``k`` rows of ``frame`` for each row of ``queries``."""
    asked = usable(queries, vec_id, vector).groupBy("id").agg(F.min("e").alias("e"))
    vectors = packed(usable(frame, vec_id, vector), VECTOR_ROWS, scale)
    asked = packed(asked, QUERY_ROWS, scale).toDF("dim", "q_ids", "q_matrix", "q_block")
    meetings = asked.select("q_block", "dim").join(vectors.select("block", "dim"), "dim").drop("dim")

    def meet(with_cutoffs: DataFrame) -> DataFrame:
        return meetings.join(with_cutoffs, "q_block").join(vectors.select("block", "ids", "matrix"), "block")

    def run(batch: pa.RecordBatch):
        out: list[list] = [[], [], []]
        for row in batch.to_pylist():
            ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
            matrix = np.frombuffer(row["matrix"]).reshape(len(ids), -1)
            q_matrix = np.frombuffer(row["q_matrix"]).reshape(len(q_ids), -1)
            cutoffs = dict(zip(row["cut_ids"] or [], row["cuts"] or []))
            for at in range(0, len(q_ids), 64):
                parts = part_scores(q_matrix[at : at + 64], matrix, lists)
                for i, q in enumerate(q_ids[at : at + 64].tolist()):
                    own = ids == q
                    if cut := cutoffs.get(q):  # phases 2 and 3
                        cut = int(cut)
                        chosen = np.flatnonzero(np.any([len(parts) * p[i] >= cut for p in parts], axis=0) & ~own)
                        whole = sum(p[i][chosen] for p in parts)
                        chosen, whole = chosen[whole >= cut], whole[whole >= cut]
                    else:  # phase 1, and queries with fewer than k candidates
                        least = min(len(ids), k + int(own.sum()))
                        tops = [np.argpartition(p[i].astype(float), len(ids) - least)[len(ids) - least :] for p in parts]
                        chosen = np.unique(np.concatenate(tops)) if row["phase"] == 1 else np.arange(len(ids))
                        chosen = chosen[~own[chosen]]
                        whole = sum(p[i][chosen] for p in parts)
                    keep = best(whole, ids[chosen], k)
                    out[0] += [q] * len(keep)
                    out[1] += ids[chosen[keep]].tolist()
                    out[2] += [str(int(x)) for x in whole[keep].tolist()]
        return out

    schema = "query_id long, vec_id long, score string"
    none = asked.withColumn("cut_ids", F.expr("CAST(NULL AS ARRAY<LONG>)")).withColumn("cuts", F.expr("CAST(NULL AS ARRAY<STRING>)"))
    order = "PARTITION BY query_id ORDER BY CAST(score AS DECIMAL(38, 0)) DESC, vec_id"
    fields = ["ids", "matrix", "q_ids", "q_matrix", "cut_ids", "cuts"]
    first = per_batch(meet(none).select(*fields, F.lit(1).alias("phase")), run, schema)
    cutoffs = first.withColumn("r", F.expr(f"row_number() OVER ({order})")).filter(f"r = {k}").select("query_id", "score")
    owners = per_batch(
        asked.select("q_block", "q_ids"),
        lambda b: [
            np.repeat(b.column(0).to_numpy(), [len(x) // 8 for x in b.column(1).to_pylist()]),
            np.concatenate([np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]),
        ],
        "q_block long, query_id long",
    )
    by_block = cutoffs.join(owners, "query_id").groupBy("q_block").agg(F.collect_list(F.struct("query_id", "score")).alias("c"))
    known = stored(by_block.selectExpr("q_block", "c.query_id AS cut_ids", "c.score AS cuts"))
    second = per_batch(meet(asked.join(known, "q_block", "left")).select(*fields, F.lit(2).alias("phase")), run, schema)
    ranked = second.withColumn("rank", F.expr(f"row_number() OVER ({order})")).filter(f"rank <= {k}")
    low, high = -(1 << 63), (1 << 63) - 1
    score = f"CAST(greatest(least(CAST(score AS DECIMAL(38, 0)), {high}), {low}) AS LONG)"
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.expr(score).alias("score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
