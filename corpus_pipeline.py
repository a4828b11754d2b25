"""From raw documents to token ids: toxicity, near duplicates, personal data, source mix, BPE.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; all but the last return the columns of ``documents``.
Every row is a document, whatever its ``doc_id``: stages that must tell rows
apart number the stored rows themselves, so rows that share an id, or have none,
are neither lost nor multiplied. Null or empty texts pass the filters; the mix
takes them never, as they have no words. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrolake.llm import bpe, mixing, neardup, pii, toxicity
from macrolake.llm.common import stored, table

#: Percent of shared 5-word shingles from which documents are near duplicates.
NEAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels, does not reject."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own as ``_row``, stored, so that all that follows sees the same numbers."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words all stay.

    The one with the smallest id stays, without ids or among equal ids the one
    with the smallest text.
    """
    rows = numbered(docs)
    groups = neardup.near_duplicates(rows, doc_id="_row", percent=NEAR).filter("n_shingles > 0").selectExpr("doc_id AS _row", "component_id AS _group")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns), "_row")
    first = rows.select("_row", order.alias("_order")).join(groups, "_row").groupBy("_group").agg(F.min("_order")["_row"].alias("_kept"))
    others = groups.join(first, "_group").filter("_row <> _kept").select("_row")
    return rows.join(others, "_row", "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced by their kind."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole copies; those it does not take go.

    What is taken of a document beyond whole copies is one more copy for as
    many of such documents as it is a part of one, chosen by a hash of the row, so
    that the words of a source stay near its target.
    """
    rows = numbered(docs)
    taken = mixing.mix(rows, doc_id="_row").filter("taken > 0").selectExpr("doc_id AS _row", "taken", "size")
    due = rows.join(taken, "_row").withColumn("_chance", F.pmod(F.xxhash64(*docs.columns, "_row"), F.lit(1 << 20)) / (1 << 20))
    copies = due.withColumn("_copies", F.expr("CAST(floor(taken / size + _chance) AS INT)")).filter("_copies > 0")
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed as little-endian 32-bit integers, with their digests."""
    encoded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.digests(encoded, "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

#: The stages learn models and merge byte pairs, which SQL cannot express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
