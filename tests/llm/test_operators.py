"""Every corpus operator against a brute-force version on the awkward table, and on an empty one."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortfit.llm import byte_bpe, exact_index, jaccard, langid, mixing, mtree, pii, suffixes, token_frames, toxicity
from cohortfit.llm.words import slices
from tests.llm.data import SCHEMA, rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def named():
    return sorted({(r[0], r[1] or "") for r in rows() if r[0] is not None})


def test_exact_dedup_and_later_batches(spark, docs, empty):
    index = exact_index.DigestIndex.fresh(spark, buckets=3)
    got = {r.doc_id: r for r in exact_index.deduplicate(docs, index).collect()}
    groups = collections.defaultdict(list)
    for doc_id, text in named():
        groups[text].append(doc_id)
    for text, ids in groups.items():
        for doc_id in ids:
            r = got[doc_id]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), doc_id == max(ids))
            assert bytes(r.digest) == hashlib.sha256(text.encode()).digest()
    again = exact_index.deduplicate(docs, index).collect()
    assert {r.doc_id: r.keep_id for r in again} == {k: r.keep_id for k, r in got.items()}
    assert index.table().count() == len(groups)
    later = spark.createDataFrame([(500, ""), (501, "new")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in exact_index.deduplicate(later, index).collect()} == {500: False, 501: True}
    assert exact_index.deduplicate(empty, exact_index.DigestIndex.fresh(spark)).count() == 0
    kept = exact_index.keep_first_copies(docs, exact_index.DigestIndex.fresh(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(ids) for ids in groups.values())


def test_byte_bpe(docs, empty):
    lines = open(byte_bpe.RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = docs.select("text", byte_bpe.encode(F.col("text")).alias("ids"))
    for r in got.select("text", "ids", byte_bpe.decode(F.col("ids")).alias("back")).collect():
        assert r.ids == encoder.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    checked = docs.select(byte_bpe.encode(F.col("text")).alias("a"), byte_bpe.encode(F.col("text"), verify=True).alias("b"))
    assert checked.where("a <> b or b is null").count() == 0
    text = words(1, 500) + " 1 2\n\n x's 'll  y " + words(2, 200)
    assert byte_bpe.encode_text(encoder, text, 50) == encoder.encode_ordinary(text)
    assert empty.select(byte_bpe.encode(F.col("text"))).count() == 0


def test_token_frames(spark, docs, empty, tmp_path):
    tokenizer = Tokenizer.from_file(token_frames.TOKENIZER)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_frames.write_tokens(docs)
    read = token_frames.read_tokens(manifest)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and read.rdd.getNumPartitions() == manifest.count()
    got = read.select("doc_id", "start", "n_tokens", "ids", token_frames.ids_crc32("ids").alias("crc")).collect()
    want, start = [], 0
    every = sorted((r[0], r[1] or "") for r in rows() if r[0] is not None)
    for doc_id, text in every:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_frames.read_tokens(token_frames.write_tokens(empty)).count() == 0
    path = tmp_path / "x.zst"
    with open(path, "wb") as out:
        writer = token_frames.FrameWriter(out)
        for k in range(3):
            writer.add(k, bytes([k]) * 400)
        writer.finish()
    system, place = token_frames._place(str(path))
    assert token_frames.FrameReader(system.open_input_file(place)).read(1) == b"\x01" * 400
    data = bytearray(path.read_bytes())
    data[10] ^= 1
    path.write_bytes(data)
    with pytest.raises(Exception):
        token_frames.FrameReader(system.open_input_file(place)).read(0)


def test_pieces_equal_the_library():
    """Random texts of what the tokenizer treats in a special way, many at once and one by one."""
    tokenizer, encoder = Tokenizer.from_file(token_frames.TOKENIZER), token_frames.PieceEncoder(token_frames.TOKENIZER)
    signs = [*"abcXYZ '.<|>1239\t\n-", "'s", "'re", "'LL", "'d", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    signs += [*"ÉßéÀ×÷İœΣςª½²_", "\u0301", "\u00a0", "\u2028", "\x85", "\x1c", "\x00", "日本", "😀"]
    r = random.Random(5)
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = [ids[a:b].tolist() for ids, bounds in encoder(texts) for a, b in zip(bounds, bounds[1:])]
    assert got == want
    assert 49407 in [i for ids in want for i in ids]
    encoder.forget()
    for text, ids in zip(texts[:200], want):
        assert [x.tolist() for x, _ in encoder([text])] == [ids]
    ids, bounds = token_frames.with_end(np.array([5, 6, 7], np.uint32), np.array([0, 0, 2, 3]), 1)
    assert ids.tolist() == [1, 5, 6, 1, 7, 1] and bounds.tolist() == [0, 1, 4, 6]


def components(texts, links):
    parent = {k: k for k in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def near(texts):
    sets = {}
    for k, t in texts.items():
        w = split(t)
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(texts)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {k: (len(sets[k]), c) for k, c in components(texts, links).items()}


def test_jaccard_join(spark, docs, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == near(dict(named()))
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, (_, c) in got.items() if k == c}


def test_jaccard_join_of_a_large_family(spark, monkeypatch):
    base = words(11, 160).split()
    texts = {}
    for k in range(90):  # copies with up to 4 changed words, so that not all pairs link
        w = list(base)
        for j in range(k % 5):
            w[(37 * k + 31 * j) % 160] = f"w{k}x{j}"
        texts[k] = " ".join(w)
    for k in range(90, 130):  # short documents around one passage
        texts[k] = words(k, 25) + " " + " ".join(base[:20])
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 3)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(table).collect()}
    assert got == near(texts)


def repeated_windows(texts):
    windows, want = collections.defaultdict(set), {}
    for k, w in texts.items():
        for i in range(len(w) - 49):
            windows[tuple(w[i : i + 50])].add(k)
    for k, w in texts.items():
        spans = []
        for i in range(len(w) - 49):
            if len(windows[tuple(w[i : i + 50])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 50)
                else:
                    spans.append((i, i + 50))
        if spans:
            want[k] = spans
    return want


def test_suffixes(docs, empty):
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffixes.repeated_passages(docs).collect()}
    assert got == repeated_windows({k: split(t) for k, t in named()})
    assert suffixes.repeated_passages(empty).count() == 0


def test_suffixes_of_one_beginning_over_many_ranges(spark):
    passage, r = words(11, 90).split(), random.Random(12)
    texts = {}
    for k in range(120):  # parts of one passage, so that partners are seldom next to each other in the order
        a = r.randrange(40)
        part = passage[a : a + r.randrange(30, 62)]
        texts[k] = f"{words(1000 + k, r.randrange(60))} {' '.join(part)} {words(2000 + k, r.randrange(60))}"
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = suffixes.repeated_passages(table).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {x.doc_id: [tuple(s) for s in x.spans] for x in found} == repeated_windows({k: split(t) for k, t in texts.items()})


def brute_spans(text):
    found = []
    for rank, kind in enumerate(pii.KINDS):
        for m in re.finditer(pii.PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def test_pii(docs, empty):
    texts = dict(named())
    for r in pii.detect(docs).select("doc_id", pii.joined(F.col("base")).alias("base"), pii.joined(F.col("spans")).alias("all")).collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base == ",".join(want)
        assert set(want) <= set(r.all.split(",")) or not want
    assert pii.detect(empty).count() == 0


def test_mixing(spark, docs, empty):
    columns = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.text_form(F.coalesce("text", F.lit("")))}
    table = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.lit("w"), 20)).alias("text"),
        F.when(F.col("id") % 10 < 7, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang"),
    )
    goal = mixing.Targets({"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.4, "y": 0.6}, "topic": {"prose": 1.0}}, keep=0.3)
    mixed = mixing.mix(table, columns, goal).toPandas()
    expected = mixed.tokens * mixed.p
    assert abs(expected.sum() / mixed.tokens.sum() - 0.3) < 1e-9
    for d in ("source", "lang"):
        shares = expected.groupby(mixed[d]).sum() / expected.sum()
        assert all(abs(shares[v] - s) < 1e-6 for v, s in goal.shares[d].items())
    assert abs(mixed[mixed.sampled].tokens.sum() / mixed.tokens.sum() - 0.3) < 0.03
    assert mixing.mix(docs, columns).count() == sum(r[0] is not None for r in rows())
    assert mixing.sample(docs, columns).columns == docs.columns
    assert mixing.mix(empty, columns).count() == 0


def test_mtree(spark):
    r = np.random.default_rng(3)
    data = [(k, r.normal(0, 0.2, 8).tolist()) for k in range(700)]
    data += [(k, data[0][1]) for k in range(700, 1000)] + [data[5], data[100], (2000, None), (2001, [float("nan")] * 8)]
    data += [(2002, [None] * 8), (None, data[0][1]), (2003, [0.5, 0.25]), (3000, [0.1, 0.2]), (3100, [])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = mtree.top_k(table, F.col("vec_id") % 100 == 0).collect()
    ints = {k: [int(np.floor(1024 * x)) for x in v] for k, v in data if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (k for k in ints if k % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), k) for k, v in ints.items() if k != q and len(v) == len(ints[q]))
        want += [(q, i, k, -s) for i, (s, k) in enumerate(scored[:10], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert mtree.top_k(none, F.col("vec_id") % 100 == 0).count() == 0


def nearest(ints, k=10):
    """Brute force over unique (id, whole numbers) pairs; queries are the ids divisible by 100."""
    want = []
    for q, x in ints:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, v)), j) for j, v in ints if j != q and len(v) == len(x))
            want += [(q, i, j, -s) for i, (s, j) in enumerate(scored[:k], 1)]
    return sorted(want)


def test_mtree_repeated_rows_count_once(spark):
    r = np.random.default_rng(5)
    data = [(100 * k, r.normal(0, 0.2, 8).tolist()) for k in range(300)]
    table = spark.createDataFrame([row for row in data for _ in range(12)], "vec_id long, embedding array<double>")
    got = mtree.top_k(table, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == nearest([(k, [int(np.floor(1024 * x)) for x in v]) for k, v in data])


def test_mtree_long_vectors_take_part(spark):
    r = np.random.default_rng(6)
    data = [(50 * k, (r.normal(0, 1, 4) * 10.0 ** r.choice([0, 4, 9, 150, 304])).tolist()) for k in range(200)]
    data += [(20_001, [1.7e308, -1.7e308, 0.1, 1e306]), (20_100, [-1.7e308, 0.0, -0.1, 1.0]), (20_200, [1024.5] * 4)]
    data += [(20_300, [0.0] * 4), (20_301, data[3][1]), data[3], data[8], (20_400, [float("inf"), 0.0, 0.0, 0.0])]

    def whole(x):  # the product as a double, or in whole numbers where no double holds it
        return int(np.floor(1024.0 * x)) if np.isfinite(1024.0 * x) else 1024 * int(x)

    with np.errstate(over="ignore"):
        ints = {(k, tuple(whole(x) for x in v)) for k, v in data if np.isfinite(v).all()}
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = nearest(sorted(ints))
    got = mtree.top_k(table, F.col("vec_id") % 100 == 0, text_scores=True).collect()
    assert sorted((q, i, v, int(s)) for q, i, v, s in got) == want
    got = mtree.top_k(table, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=lambda t: t[:2]) == [(*t[:3], t[3] if -(2**63) <= t[3] < 2**63 else None) for t in want]


def test_mtree_skips_computations():
    r = np.random.default_rng(4)
    centres = r.integers(-300, 300, (20, 6))
    x = (centres[r.integers(0, 20, 3000)] + r.integers(-5, 6, (3000, 6))).astype(np.int64)
    most = float((x * x).sum(axis=1).max())
    tree = mtree.Tree(mtree.build(np.arange(3000), x, most), most)
    ids, scores = tree.search(-1, x[7], 10, None)
    every = x @ x[7]
    order = np.lexsort((np.arange(3000), -every))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
    assert tree.computed < 1500


def test_toxicity_held_out(spark, docs, empty):
    data = [(k, words(k, 60) + (" you vile moron" if k % 4 == 0 else ""), int(k % 4 == 0)) for k in range(1200)]
    table = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    labels = table.where("doc_id < 800").select("doc_id", "toxic", F.lit(None).cast("int").alias("rude"))
    chain = toxicity.train(table, labels, ["rude", "toxic"])
    got = toxicity.classify(table, chain).where("doc_id >= 800").select("toxic", "toxicity.flagged").collect()
    assert all(r.flagged == bool(r.toxic) for r in got)
    assert toxicity.classify(docs, chain).count() == len(rows())
    assert toxicity.classify(empty, chain).count() == 0
    untrained = toxicity.train(docs, labels.limit(0), ["rude", "toxic"])
    assert not any(r.flagged for r in toxicity.classify(docs, untrained).select("toxicity.flagged").collect())


def test_langid_held_out(spark, docs, empty):
    r = np.random.default_rng(1)
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["qu", "eau", "oi"]}
    data = []
    for k in range(600):
        lang = ["aa", "bb", "cc"][k % 3]
        data.append((k, " ".join("".join(r.choice(sounds[lang], 3)) for _ in range(30)), lang))
    table = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.train(table.where("doc_id < 400"))
    rows_ = table.where("doc_id >= 400").select("lang", langid.predict(F.col("text"), model).alias("p")).collect()
    assert np.mean([x.lang == x.p.lang for x in rows_]) > 0.98 and all(0 <= x.p.score <= 1 for x in rows_)
    odd = {x.doc_id: x.p for x in docs.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()}
    assert odd[0].lang == odd[1].lang == odd[14].lang == "und" and odd[0].score == 0
    assert langid.train(empty).languages == []


def test_word_slices_do_not_depend_on_their_size():
    import pyarrow as pa

    texts = pa.array([r[1] for r in rows()])

    def hashes(size):
        return np.concatenate([s.grams(5)[0] for s in slices(texts, size)])

    assert (hashes(100) == hashes(10_000_000)).all()
