"""The trees of op3: held-out recall, spans added end to end, and what stays untouched."""

import random

import pytest
from pyspark.sql import functions as F

from cohortfit.llm import pii
from cohortfit.llm.cell_trees import Cell, threshold
from tests.llm.data import words


def card(r, good=True):
    digits = [r.randint(0, 9) for _ in range(15)]
    total = sum(d if k % 2 else (2 * d - 9 * (2 * d > 9)) for k, d in enumerate(digits))
    last = -total % 10
    return "".join(map(str, digits)) + str(last if good else (last + r.randint(1, 9)) % 10)


def plain(r, k):
    return [
        f"{words(k, 1)}.{k}@mail{k % 9}.example.com",
        ".".join(str(r.randint(0, 255)) for _ in range(4)),
        card(r),
        f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}",
    ][k % 4]


#: Kind and text of spans that no pattern accepts.
DISGUISED = [
    ("email", "jo.doe (at) mail.example.org"),
    ("email", "info[at]shop.example.net"),
    ("ip", "300.12.7.44"),
    ("card", "4539148803436468"),
    ("card", "1219.5381.1253.5716"),
    ("phone", "001 (974) 555-3436"),
]
HARMLESS = ["2024-11-03", "1.2.3", "bc0d31ba76f17e56642e8751295a3fd50cd8e61f", "12345", "@handle", "123456789012345678901234567"]


@pytest.fixture(scope="module")
def corpus(spark):
    r, texts = random.Random(3), []
    for k in range(600):
        texts.append(f"{words(k, 12)} {plain(r, k)} {words(k + 1000, 9)}")
    texts += [f"{words(2000 + k, 8)} {t} {words(3000 + k, 8)}" for k, (_, t) in enumerate(DISGUISED)]
    texts += [f"{words(4000 + k, 8)} {t} {words(5000 + k, 8)}" for k, t in enumerate(HARMLESS)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


@pytest.fixture(scope="module")
def found(corpus):
    return pii.scanned(corpus).cache()


@pytest.fixture(scope="module")
def detector(found):
    return pii.train(found)


def test_held_out_recall_and_precision(detector):
    assert min(detector.recall.values()) >= 0.9, detector
    assert all(0 < detector.cuts[k] < 1 for k in pii.KINDS)


def test_disguised_spans_are_added_and_redacted(corpus, found, detector):
    spans = pii.with_added(found, detector)
    rows = spans.join(corpus, "doc_id").select("doc_id", "text", "base", "spans", pii.redact(F.col("text"), F.col("spans")).alias("clean"))
    rows = {r.doc_id: r for r in rows.collect()}
    for k in range(600):
        assert rows[k].spans == rows[k].base and len(rows[k].base) == 1
    for k, (kind, text) in enumerate(DISGUISED, 600):
        r = rows[k]
        assert r.base == [] and [(s.kind, r.text[s.start : s.end]) for s in r.spans] == [(kind, text)]
        assert r.clean == r.text.replace(text, f"[{kind.upper()}]")
    for k in range(606, 606 + len(HARMLESS)):
        assert rows[k].spans == [] and rows[k].clean == rows[k].text


def test_redaction_of_overlapping_spans(spark):
    text = "ab cd ef gh"
    spans = [(0, 0, 5, "email"), (3, 1, 8, "ip"), (9, 2, 11, "card")]
    kind = "array<struct<start:long,rank:int,end:long,kind:string>>"
    row = spark.createDataFrame([(text, spans), ("", []), ("x", [])], f"text string, spans {kind}")
    got = [r[0] for r in row.select(pii.redact(F.col("text"), F.col("spans"))).collect()]
    assert got == ["[EMAIL] [CARD]", "", "x"]


def test_nothing_to_learn_from(spark):
    rows = [(1, "call 001 974 555 3436"), (2, None), (None, "a@b.c")]
    got = pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.spans) for r in got) == [(1, []), (2, [])]


def test_threshold():
    good, bad = Cell((0,), 100, 98), Cell((1,), 100, 2)
    assert threshold([(0.9, good), (0.1, bad)], 0.9) == 0.5
    assert threshold([(0.9, bad)], 0.9) == 2.0 and threshold([], 0.9) == 2.0
