"""The stages of the pipeline on awkward tables, one after the other and against plain Python."""

import hashlib

import corpus_pipeline
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortfit.llm import exact_index, mixing
from cohortfit.llm.queries import mix_columns
from tests.llm.data import SCHEMA, rows
from tests.llm.test_operators import near

CLASHING = ["id", "dropped", "toxicity", "row", "__id", "__tokens", "__source", "__dropped"]


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.createDataFrame(rows(), SCHEMA).withColumns({c: F.lit(c) for c in CLASHING})
    return table.repartition(3).cache()


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mixing", "byte_bpe"]


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(3).withColumn("toxicity", F.lit(1)).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.withColumn("toxicity", F.lit(2))
    kept = corpus_pipeline.drop_toxic(spark, docs.unionByName(odd), sf)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    left = set(ids(kept))
    assert None not in left and len(left & toxic) < len(toxic) / 2 and len(left & clean) > 0.9 * len(clean)
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), sf).count() == 0


def test_exact_copies_go(spark, docs, monkeypatch):
    texts = {(r[0], r[1] or "") for r in rows() if r[0] is not None}
    want = sorted(max(i for i, t in texts if t == text) for text in {t for _, t in texts})
    for most in (500_000, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(exact_index, "BROADCAST_IDS", most)
        kept = corpus_pipeline.exact_dedup(spark, docs, "")
        assert kept.columns == docs.columns and ids(kept) == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")]
    two = spark.createDataFrame([(1, "a", "z"), (1, "a", "b"), (1, "a", None), (2, "c", "q")], "doc_id long, text string, __id string")
    assert sorted(map(tuple, corpus_pipeline.exact_dedup(spark, two, "").collect())) == [(1, "a", None), (2, "c", "q")]
    assert corpus_pipeline.exact_dedup(spark, docs.limit(0), "").count() == 0


def test_near_copies_go(spark, docs):
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    groups = near(dict(sorted({(r[0], r[1] or "") for r in rows() if r[0] is not None})))
    assert kept.columns == docs.columns
    assert set(ids(kept)) == {k for k, (_, c) in groups.items() if k == c}
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_mixing_samples_what_the_operator_decides(spark, docs):
    kept = corpus_pipeline.mix_sources(spark, docs, "")
    decided = {r.doc_id: r.sampled for r in mixing.mix(docs, mix_columns()).collect()}
    named = [r[0] for r in rows() if r[0] is not None]
    assert kept.columns == docs.columns and ids(kept) == sorted(k for k in named if decided[k])
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), "").count() == 0


def test_encoding(spark, docs):
    import base64

    import public_tokenizers

    from cohortfit.llm import byte_bpe

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.RANKS, "rb").read().splitlines())}
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {(r.doc_id, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.encode_tokens(spark, docs, "").collect()}
    want = {(r[0], len(e := encoder.encode_ordinary(r[1] or "")), tuple(e)) for r in rows()}
    assert got == want
    assert corpus_pipeline.encode_tokens(spark, docs.limit(0), "").count() == 0


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf).collect()
    assert len({r.doc_id for r in got}) == len(got) > 0
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    digests = [hashlib.sha256(texts[r.doc_id].encode()).digest() for r in got]
    assert len(set(digests)) == len(digests)
    assert all(r.n_tokens == len(r.ids) for r in got)
