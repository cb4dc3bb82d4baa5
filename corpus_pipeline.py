"""From raw documents to token ids in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.llm import byte_bpe, exact_index, jaccard, mixing, toxicity
from cohortfit.llm.batches import materialize, unused
from cohortfit.llm.queries import mix_columns, toxicity_chain

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain flags go; rows without an id are no documents."""
    named = docs.where(F.col("doc_id").isNotNull())
    (out,) = unused(named, "toxicity")
    rated = toxicity.classify(named, toxicity_chain(spark, named, sf_dir), out=out)
    return rated.where(~F.col(out)["flagged"]).drop(out)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    index = exact_index.DigestIndex.fresh(spark)
    kept = exact_index.keep_first_copies(docs, index)
    index.drop()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by 5-word shingles at 0.75 or more, the smallest id stays."""
    return jaccard.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled towards the target shares of source, language and topic."""
    return mixing.sample(docs, mix_columns())


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids``, after a check that the ids decode to the text."""
    rows = docs.select("doc_id", "source", "lang", byte_bpe.encode(F.col("text"), verify=True).alias("ids"))
    return rows.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", near_dedup),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: A trained classifier and a tokenizer decide the rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
