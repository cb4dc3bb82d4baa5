"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.llm import (
    byte_bpe,
    centroids,
    exact_index,
    jaccard,
    langid,
    mixing,
    mtree,
    pii,
    suffixes,
    token_frames,
    toxicity,
    url_filter,
    vector_codes,
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_passages(documents(spark, folder))
    return found.withColumn("spans", suffixes.joined(F.col("spans")))


def toxicity_chain(spark: SparkSession, docs: DataFrame, folder: str) -> toxicity.Chain:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.train(docs, labels, ["low_quality", "toxic"])


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    rated = toxicity.classify(docs, toxicity_chain(spark, docs, folder))
    return rated.select(
        "doc_id",
        F.col("toxicity.p_low_quality").alias("p_low_quality"),
        F.col("toxicity.p_toxic").alias("p_toxic"),
        F.col("toxicity.flagged").alias("toxic"),
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(documents(spark, folder))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") > 0).alias("private"),
    )


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, folder))


def op5_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_frames.write_tokens(documents(spark, folder))
    return token_frames.read_tokens(manifest).select(
        "doc_id", "start", "n_tokens", token_frames.ids_crc32("ids").alias("ids_crc32")
    )


def op6_mtree_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return mtree.top_k(rows, F.col("vec_id") % 100 == 0)


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = documents(spark, folder).select("doc_id", byte_bpe.encode(F.col("text")).alias("ids"))
    decoded = encoded.select("doc_id", "ids", byte_bpe.decode(F.col("ids")).alias("bytes"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def mix_columns() -> dict[str, Column]:
    topic = mixing.text_form(F.coalesce(F.col("text"), F.lit("")))
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), mix_columns())
    return mixed.withColumns({"factor": F.round("factor", 6), "p": F.round("p", 6)})


def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), model).alias("found"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = exact_index.deduplicate(documents(spark, folder), exact_index.DigestIndex.fresh(spark))
    return decided.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = vector_codes.compress(embeddings(spark, folder))
    codes = codes.withColumn("codebooks_sha256", F.lit(books.sha256()))
    return codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(embeddings(spark, folder))[0]


#: Rules of the registered query.
URL_RULES = [
    url_filter.Rule(False, "com"),
    url_filter.Rule(True, "example.com", "/en/"),
    url_filter.Rule(False, "www.example.com", "/en/"),
    url_filter.Rule(True, "net", "/es/"),
    url_filter.Rule(True, "net", "/fr/"),
]


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{folder}/pages.parquet"), URL_RULES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_toxicity,
        op3_pii,
        op4_ngram_jaccard,
        op5_token_frames,
        op6_mtree_topk,
        op7_byte_bpe,
        op8_mixing,
        op9_langid,
        op10_exact_dedup,
        op11_vector_codes,
        op12_centroids,
        op13_url_filter,
    )
}


def _codes_sql() -> str:
    """Four rounds of assigning parts to entries and averaging, then codes and errors."""
    nearest = """
        select part, row, x, arg_min(entry, (d, entry)) as entry, min(d) as d from (
            select p.part, p.row, p.x, b.entry, list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.x)
                + list_dot_product(b.x, b.x) as d
            from parts p join book{k} b on b.part = p.part
        ) group by part, row, x"""
    ctes = ["""
        kept as (
            select vec_id, label, list_transform(embedding, lambda v: floor(1024 * v::double)) as x,
                   row_number() over (order by vec_id, embedding) as row
            from embeddings
            where vec_id is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
        ), parts as (
            select row, t.p as part, x[t.p * len(x) // 4 + 1 : (t.p + 1) * len(x) // 4] as x
            from kept cross join range(4) t(p)
        ), book0 as (select part, row - 1 as entry, x from parts where row <= 256)"""]
    for k in range(4):
        ctes.append(f"""
        near{k} as materialized ({nearest.format(k=k)}
        ), mean{k} as (
            select part, entry, list(v order by pos) as x from (
                select part, entry, pos, floor(sum(v) / count(*)) as v
                from (select part, entry, unnest(x) as v, generate_subscripts(x, 1) as pos from near{k}) group by all
            ) group by all
        ), book{k + 1} as materialized (
            select part, entry, coalesce(m.x, b.x) as x from book{k} b left join mean{k} m using (part, entry)
        )""")
    ctes.append(f"""
        last as ({nearest.format(k=4)}
        ), coded as (
            select row, string_agg(lower(printf('%02x', entry::int)), '' order by part) as code, sum(d)::bigint as error
            from last group by row
        ), digits as (
            select string_agg(v::bigint::varchar, ',' order by part, entry, pos) as s
            from (select part, entry, unnest(x) as v, generate_subscripts(x, 1) as pos from book4)
        )""")
    return f"""with {','.join(ctes)}
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
               sha256((select s from digits)) as codebooks_sha256
        from coded join kept using (row)"""


def _centroids_sql() -> str:
    """Three rounds of assigning vectors to centroids and averaging, then distances."""
    nearest = """
        select row, vec_id, x, arg_min(cluster, (d, cluster)) as cluster, min(d)::bigint as distance from (
            select v.row, v.vec_id, v.x, c.cluster, list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, c.x)
                + list_dot_product(c.x, c.x) as d
            from kept v cross join centre{k} c
        ) group by row, vec_id, x"""
    ctes = ["""
        kept as (
            select vec_id, list_transform(embedding, lambda v: floor(64 * v::double)) as x,
                   row_number() over (order by sha256('1:' || vec_id::varchar), embedding) as row
            from embeddings
            where vec_id is not null and len(embedding) = 64
              and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
        ), centre0 as (select (row - 1)::int as cluster, x from kept where row <= 16)"""]
    for k in range(3):
        ctes.append(f"""
        near{k} as materialized ({nearest.format(k=k)}
        ), mean{k} as (
            select cluster, list(v order by pos) as x from (
                select cluster, pos, floor(sum(v) / count(*)) as v
                from (select cluster, unnest(x) as v, generate_subscripts(x, 1) as pos from near{k}) group by all
            ) group by all
        ), centre{k + 1} as materialized (
            select cluster, coalesce(m.x, c.x) as x from centre{k} c left join mean{k} m using (cluster)
        )""")
    return f"""with {','.join(ctes)}, last as ({nearest.format(k=3)}
        ), digests as (
            select cluster, sha256(string_agg(v::bigint::varchar, ',' order by pos)) as centroid_sha256
            from (select cluster, unnest(x) as v, generate_subscripts(x, 1) as pos from centre3) group by cluster
        )
        select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
               (sum(distance) over ())::bigint as inertia, centroid_sha256
        from last join digests using (cluster)"""


ORACLES = {
    "op4_ngram_jaccard": """
        with recursive lowered as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda w: w <> '') as w
            from documents where doc_id is not null
        ), shingles as (
            select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
            from lowered
        ), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        met as (
            select a.doc_id as a, b.doc_id as b, count(*) as i
            from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
        ), links as (
            select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * i >= 75 * (x.n + y.n - i)
        ), edges as (select a, b from links union all select b, a from links),
        reach as (
            select doc_id as node, doc_id as least from lowered
            union select b, least from reach join edges on a = node
        )
        select l.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(least) as component_id
        from lowered l left join sizes s on s.doc_id = l.doc_id join reach on node = l.doc_id group by l.doc_id""",
    "op6_mtree_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as x from embeddings
            where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, v.vec_id, list_dot_product(q.x, v.x)::bigint as score
            from v q join v on q.vec_id % 100 = 0 and q.vec_id <> v.vec_id
        ), ranked as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
                   vec_id, score from scored
        )
        select * from ranked where rank <= 10""",
    "op10_exact_dedup": """
        with d as (select distinct doc_id, sha256(coalesce(text, '')) as text_sha256 from documents where doc_id is not null)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, text_sha256
        from d window w as (partition by text_sha256)""",
    "op11_vector_codes": _codes_sql(),
    "op12_centroids": _centroids_sql(),
}
