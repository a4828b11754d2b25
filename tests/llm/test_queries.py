"""The registered queries against their SQL, and the pipeline's stages, on the smallest test tables."""

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402

from macrolake.llm import bpe, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    problems, _ = oracle.differences(spark, oracle.connect(SF_DIR), queries.QUERIES[name], queries.ORACLE_SQL[name], SF_DIR)
    assert problems == []


def test_pipeline_stages(spark):
    docs = before = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR))
        assert docs.schema.names == before.schema.names
        assert docs.select("doc_id").distinct().count() <= before.select("doc_id").distinct().count()
        before = docs
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    encoder = bpe.Encoder(bpe.Vocabulary(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")), None)
    texts = [r.text for r in docs.collect()]
    assert sorted(r.ids for r in last) == sorted(map(bytes, encoder.encode(texts)))


def test_pipeline_takes_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR))
    assert docs.count() == 0


def test_pipeline_keeps_rows_that_share_an_id_or_have_none(spark):
    text = "a clean text about the {} weather in the {} part of the country , which changes from {} to {} and back"
    texts = [" ".join(text.format(w, x, y, w) for x in ("northern", "southern") for y in range(3)) for w in ("cold", "warm", "wet", "dry", "calm", "harsh")]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[4]), (3, texts[4]), (None, texts[4]), (4, texts[5]), (5, None), (5, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 2}", len(t or "")) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    want = {(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[4]), (4, texts[5]), (5, None), (5, ""), (None, None)}
    assert len(once) == len(want) and {(r.doc_id, r.text) for r in once} == want
    reversed_ = corpus_pipeline.drop_near_duplicates(spark, docs.orderBy(F.desc("text")), SF_DIR).collect()
    assert {(r.doc_id, r.text) for r in reversed_} == want
    mixed = Counter((r.doc_id, r.text) for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect())
    given = Counter(rows)
    assert set(mixed) <= set(given) and all(n <= 3 * given[k] for k, n in mixed.items())
    assert sum(n for (i, _), n in mixed.items() if i is None) > 0 and mixed[1, texts[1]] <= 6


def test_mixed_sources_stay_near_their_targets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = F.expr("regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')")
    mixed = {r.source: r.n for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).groupBy("source").agg(F.sum(words).alias("n")).collect()}
    due = corpus_pipeline.mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").select("source", "target").distinct().collect()
    assert sum(abs(mixed.get(r.source, 0) - r.target) for r in due) <= 0.25 * sum(r.target for r in due)
