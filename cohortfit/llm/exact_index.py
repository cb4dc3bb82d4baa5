"""Exact deduplication against a persistent digest index.

The index is a Parquet table of one row per distinct text, bucketed and sorted by the
text's SHA-256. A batch is deduplicated by a sort-merge anti-join: digests that the
index lacks are appended, and every row then takes the surviving id of its digest from
the index. Running a batch again changes nothing, so a job that died can be repeated.

Defined results: a NULL text counts as empty; rows without an id are left out; rows
repeated with the same id and text are one document; of equal texts in one batch the
largest id stays, and a text that the index already knows is dropped whatever its id.
Columns other than the id and the text are never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize, unused
from cohortfit.session import shared_dir

#: A digest held by more than this share of a batch's documents is joined by broadcast:
#: there are at most 1 / HOT_SHARE such digests, whatever the size of the batch.
HOT_SHARE = 1 / 1000

#: Documents (some 60 bytes each) that are broadcast instead of shuffling texts for them.
BROADCAST_IDS = 500_000


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class DigestIndex:
    """The table ``digest, keep_id`` at ``path``; opened if it exists, else made empty.

    ``buckets`` is fixed when the index is made: about index size / 128 MB.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int | None = None) -> DigestIndex:
        """An empty index in the shared folder."""
        return cls(spark, f"{shared_dir(spark)}/cohortfit/digest-index-{uuid.uuid4().hex}", buckets)

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index lacks."""
        return groups.join(self.table().hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add the unseen digests; one file per bucket and append."""
        new = self.unseen(groups).select("digest", "keep_id")
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add the batch to the index and decide every document of it.

    Returns ``doc_id, digest, keep_id, group_size, kept``: the id that stays for this
    text, the number of documents of the batch with this text, and whether this is it.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))
    rows = materialize(named.where(F.col("doc_id").isNotNull()).distinct(), "digests")
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(groups, "digest-groups")
    index.append(groups)
    settled = groups.drop("keep_id").join(index.table().hint("merge"), "digest")

    most = F.lit(max(1.0, rows.count() * HOT_SHARE))
    hot = F.broadcast(settled.where(F.col("group_size") > most))
    cold = settled.where(F.col("group_size") <= most)
    joined = rows.join(hot, "digest").unionByName(
        rows.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    )
    return joined.select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept")
    )


def keep_first_copies(
    docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, each once, with all their columns.

    The digests decide; texts move only for what has to be found among them: few dropped or
    repeated documents are broadcast, so that no text is shuffled, more are met by a join.
    Of rows with the same id and text the least one by all columns stays (maps compare as text).
    """
    decided = materialize(deduplicate(docs, index, id_col=id_col, text_col=text_col), "digests-decided")
    own_id, own_digest = unused(docs, "id", "digest")
    rows = docs.where(F.col(id_col).isNotNull())
    rows = rows.withColumns({own_id: F.col(id_col).cast("long"), own_digest: text_digest(F.col(text_col))})
    key = [own_id, own_digest]
    named = [F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest)]
    dropped = _sized(decided.where(~F.col("kept")).select(*named))
    counted = rows.select(*key).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = _sized(materialize(counted, "digests-repeated").join(dropped, key, "left_anti"))
    kept = rows.join(dropped, key, "left_anti")
    once = kept.join(repeated, key, "left_anti").select(*docs.columns)
    maps = any("map<" in f.dataType.simpleString() for f in docs.schema.fields)
    whole = F.struct(*docs.columns)
    first = F.min_by(whole, F.to_json(whole)) if maps else F.min(whole)
    least = kept.join(repeated, key, "left_semi").groupBy(*key).agg(first.alias("row"))
    return once.unionByName(least.select("row.*"))


def _sized(documents: DataFrame) -> DataFrame:
    """Ids and digests, to be broadcast if they are few."""
    documents = materialize(documents, "digests-few")
    return F.broadcast(documents) if documents.count() <= BROADCAST_IDS else documents
