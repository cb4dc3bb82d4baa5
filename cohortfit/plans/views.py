"""Feature tables built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.schemas import Roles
from cohortfit.sources.tables import read_table

DOC_ROLES = Roles(
    group="lang",
    id="doc_id",
    label="quality",
    categorical=("source",),
    numeric=("n_chars", "n_words", "unique_ratio", "letter_share", "digit_share"),
)
ORD_ROLES = Roles(
    group="segment",
    id="o_orderkey",
    label="label",
    categorical=("o_orderpriority",),
    numeric=("o_totalprice", "c_acctbal"),
)


def documents_view(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with text statistics; whole texts, measured in the JVM."""
    docs, labels = read_table(spark, folder, "documents", heavy=True), read_table(spark, folder, "labels")
    words = F.split("text", " ")
    chars = F.nullif(F.col("n_chars").cast("double"), F.lit(0.0))

    def share(pattern):
        return F.length(F.regexp_replace("text", pattern, "")).cast("double") / chars

    return docs.join(labels.select("doc_id", "quality"), "doc_id").select(
        "doc_id",
        "lang",
        "source",
        "quality",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        (F.size(F.array_distinct(F.split(F.lower("text"), " "))).cast("double") / F.size(words)).alias("unique_ratio"),
        share("[^A-Za-z ]").alias("letter_share"),
        share("[^0-9]").alias("digit_share"),
    )


def orders_view(spark: SparkSession, folder: str, *, heavy: bool = False) -> DataFrame:
    orders, customer = read_table(spark, folder, "orders", heavy=heavy), read_table(spark, folder, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.select(
        "o_orderkey",
        F.col("c_mktsegment").alias("segment"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        "o_orderpriority",
        "o_totalprice",
        "c_acctbal",
    )


def events_view(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("event_id", "event_type", "user_id", "ts", "value")
