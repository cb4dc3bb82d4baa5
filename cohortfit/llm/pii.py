"""Personal data in texts: pattern matches, and further spans chosen by boosted trees.

Base spans are the validated matches of one pattern per kind. Beside them, high-recall
generators propose candidates, which may overlap each other: anything around an @ or an
"(at)", dotted numbers, digit groups with any separator, numbers that look dialled. They
are there to find what is written or copied wrongly and what the patterns do not know:
cards with a wrong digit or other separators, phones without a plus, addresses with a
bracketed at, IPs with a part too large.

A candidate is described by a few small integers on its format and context. Boosted trees
learn from examples that the patterns do not decide. Positive ones are corrupted copies of
the corpus's own validated matches, each in the surroundings of its match (``corrupted``).
Negative ones are numbers, dates, versions, codes and handles made from digests and put at
a random place of every document (``harmless``), and what the generators of the other kinds
propose around a corrupted copy. Candidates are proposed by the same generators as in texts. Per kind, negatives count as much as positives in total;
a candidate is redacted if its score passes the threshold of its kind, the one of best F1
out of fold on such a balanced set among those of a precision of ``PRECISION`` or more.

Everything is DataFrame functions. Texts are read once, row by row and without a shuffle.
The trees need only the numbers of positives and candidates per description, counted over
all documents; there are at most as many descriptions as the grid has cells (``CELLS`` a
fold, some 200 bytes each as rows on the driver), so the fit does not grow with the data.
Trees are applied as CASE expressions.

Patterns are written so that Java's matcher never scans a run twice: a match may start
only at the beginning of a run or where the last match ended. They accept exactly what
the plain forms in ``PLAIN`` accept.

Defined results: a NULL or empty text has no spans; texts of any length are read whole; rows
without an id are left out; repeated rows give repeated results; a candidate that overlaps a
base span of any kind is not added, those that overlap only each other are all added, in
order of start, kind and end, and are redacted as one stretch of the first one's kind; with
no match of a kind in the corpus, none of that kind is added.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize
from cohortfit.llm.cell_trees import Boosted, Cell, boost, merged, out_of_fold, threshold

KINDS = ("email", "ip", "card", "phone")

# The patterns of the four kinds.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: The same without repeated scans.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Candidates of each kind.
LOOSE = {
    "email": r"(?:\G|(?<![^\x20\x09-\x0D@<>,;:\"()\[\]]))[^\x20\x09-\x0D@<>,;:\"()\[\]]++(?:@|\x20?[(\[]at[)\]]\x20?)[^\x20\x09-\x0D@<>,;:\"()\[\]]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){2,}+",
    "card": r"[0-9](?:[\x20./_-]?[0-9]){9,}+",
    "phone": r"[+(]?+[0-9](?:[\x20().-]{0,3}+[0-9]){6,}+",
}

#: A text without this cannot hold a match of the kind; spares most texts the matcher.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": "[0-9]"}

#: Words before a candidate that speak for a kind, by class.
CONTEXT = (
    r"e-?mail|contact|kontakt|correo|courriel",
    r"tel|phone|call|fax|mobil|handy|whatsapp",
    r"card|visa|karte|tarjeta|carte|iban|konto|account",
    r"\bip\b|host|server|address|port",
)
WINDOW = 24

#: Codes per feature; their product bounds the number of descriptions.
FEATURES = {"kind": 4, "digits": 8, "groups": 6, "marks": 8, "plus": 2, "left": 3, "right": 3, "context": 5, "domain": 3}
SIZES = list(FEATURES.values())
CELLS = prod(SIZES)
#: Most digits of the codes of ``digits``, the last being open.
DIGIT_ENDS = (6, 8, 11, 13, 15, 16, 19)

PRECISION = 0.9
FOLDS = 3
#: Trees deep enough to tell a format of one kind from the same of another.
FIT = {"rounds": 30, "depth": 4}

#: Spans are summed up in chunks of so many, as appending to an array copies it.
CHUNK = 128


def _running(pieces: Column) -> Column:
    """``start, end`` of every match, from its length and that of the gap before it."""

    def place(state, x):
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["len"]).alias("end"))
        return F.struct(F.concat(state["spans"], F.array(span)).alias("spans"), (start + x["len"]).alias("at"))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def inside(chunk, base):
        begin = F.struct(none.alias("spans"), base.alias("at"))
        return F.aggregate(chunk, begin, place, lambda s: s["spans"])

    zero = F.lit(0).cast("bigint")
    numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int"))
    chunks = F.transform(numbers, lambda c: F.slice(pieces, c * CHUNK + 1, CHUNK))
    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x["gap"] + x["len"]))
    bases = F.aggregate(
        totals,
        F.struct(F.array().cast("array<bigint>").alias("all"), zero.alias("at")),
        lambda s, t: F.struct(F.concat(s["all"], F.array(s["at"])).alias("all"), (s["at"] + t).alias("at")),
        lambda s: s["all"],
    )
    return F.flatten(F.zip_with(chunks, bases, inside))


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches as ``start, end, text, before, after``: code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(
        found,
        F.slice(gaps, 1, F.size(found)),
        lambda m, g: F.struct(F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("len")),
    )
    spans = F.zip_with(
        _running(lengths),
        found,
        lambda s, m: F.struct(s["start"].alias("start"), s["end"].alias("end"), m.alias("text")),
    )
    full = F.transform(
        spans,
        lambda s, i: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["text"].alias("text"),
            F.right(F.element_at(gaps, i + 1), F.lit(WINDOW)).alias("before"),
            F.left(F.element_at(gaps, i + 2), F.lit(1)).alias("after"),
        ),
    )
    kind = "array<struct<start:bigint,end:bigint,text:string,before:string,after:string>>"
    return F.when(text.rlike(needs) & text.rlike(pattern), full).otherwise(F.array().cast(kind))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a number of up to 19 digits passes the checksum of card numbers."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])?(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def base_matches(text: Column, kind: str) -> Column:
    needs = r"\+[0-9]" if kind == "phone" else NEEDS[kind]
    return F.filter(matches(text, BASE[kind], needs), lambda m: valid(kind, m["text"]))


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: _span(m, kind))


def base_spans(text: Column, kind: str) -> Column:
    return _spans(base_matches(text, kind), kind)


def _span(m: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind)).alias("rank")
    return F.struct(m["start"].alias("start"), rank, m["end"].alias("end"), F.lit(kind).alias("kind"))


def _edge(char: Column) -> Column:
    return F.when(char.rlike(r"^[\p{L}\p{N}]"), 1).when(char.rlike(r"^[^\s]"), 2).otherwise(0)


def candidates(text: Column, kind: str) -> Column:
    """Candidates with their spans, descriptions and whether they hold a validated match."""

    def described(m):
        t, before = m["text"], F.lower(m["before"])
        n = F.length(_digits(t))
        context = F.lit(0)
        for k, words in reversed(list(enumerate(CONTEXT, 1))):
            context = F.when(before.rlike(words), k).otherwise(context)
        held = F.exists(F.regexp_extract_all(t, F.lit(BASE[kind]), F.lit(0)), lambda x: valid(kind, x))
        codes = {
            "kind": F.lit(KINDS.index(kind)),
            "digits": sum((n > end).cast("int") for end in DIGIT_ENDS),
            "groups": F.least(F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))), F.lit(5)),
            "marks": t.contains(" ").cast("int") + t.rlike("[()/_-]").cast("int") * 2 + t.contains(".").cast("int") * 4,
            "plus": t.startswith("+").cast("int"),
            "left": _edge(F.right(m["before"], F.lit(1))),
            "right": _edge(m["after"]),
            "context": context,
            "domain": F.when(t.rlike(r"(?:@|at[)\]]).*\.[A-Za-z]{2,}+$"), 2).when(t.rlike(r"(?:@|at[)\]]).*\."), 1).otherwise(0),
        }
        return F.struct(
            _span(m, kind).alias("span"), held.alias("held"), *[v.cast("int").alias(k) for k, v in codes.items()]
        )

    return F.transform(matches(text, LOOSE[kind], NEEDS[kind]), described)


#: Ways to corrupt a match, all of them used, and kinds of harmless strings, one per document.
VARIANTS = 3


def _one_of(forms: list[Column], variant: Column) -> Column:
    out = forms[-1]
    for k in range(len(forms) - 2, -1, -1):
        out = F.when(variant == k, forms[k]).otherwise(out)
    return out


def corrupted(kind: str, text: Column, variant: Column) -> Column:
    """A match as it might be mistyped, misread or disguised."""
    if kind == "email":
        return F.replace(text, F.lit("@"), _one_of([F.lit(form) for form in (" (at) ", "[at]", "(at)")], variant))
    if kind == "ip":  # a part that no byte holds, first or last
        parts = F.transform(F.split(text, r"\."), lambda part, i: F.when(
            i == F.when(variant == 0, 0).otherwise(variant + 1), (part.cast("decimal(38,0)") + 256).cast("string")
        ).otherwise(part))
        return F.array_join(parts, ".")
    if kind == "card":  # a wrong digit, or other separators
        last = ((F.right(text, F.lit(1)).cast("int") + 1 + 3 * variant) % 10).cast("string")
        wrong = F.concat(F.left(text, F.length(text) - 1), last)
        return F.when(variant < 2, wrong).otherwise(F.regexp_replace(_digits(text), "([0-9]{4})(?=[0-9])", "$1."))
    without = F.substring(text, F.lit(2), F.length(text))
    return _one_of([F.concat(F.lit("00"), without), without, F.concat(F.lit("("), F.replace(without, F.lit("("), F.lit("")))], variant)


def harmless(kind: str, seed: Column, variant: Column) -> Column:
    """A string of the kind's characters that is no personal data, from a digest."""
    number = lambda salt, most: F.pmod(F.xxhash64(seed, F.lit(f"{kind}{salt}")), F.lit(most))
    digits = F.concat(*[F.lpad(number(f"d{k}", 10**15).cast("string"), 15, "0") for k in range(2)])
    code = F.md5(F.concat(seed.cast("string"), F.lit(kind)))
    if kind == "email":  # handles, mentions, sums with an at
        forms = [(0, "@", 6), (3, "@", 6), (2, "(at)", 1)]
        return _one_of([F.concat(F.left(code, F.lit(a)), F.lit(at), F.right(code, F.lit(b))) for a, at, b in forms], variant)
    date = F.concat_ws("." if kind == "ip" else "-", *[number(f"p{k}", most).cast("string") for k, most in enumerate((31, 12, 40))])
    some = F.left(digits, 1 + number("n", 28).cast("int"))  # a number of any length
    if kind == "ip":  # an outline number of three or of five to eight parts
        few = F.when(number("n", 2) == 0, 5).otherwise(9 + 2 * number("m", 4)).cast("int")
        some = F.left(F.regexp_replace(F.left(digits, F.lit(9)), "([0-9])(?=[0-9])", "$1."), few)
    article = F.concat(F.left(digits, 8 + number("n", 4).cast("int")), F.left(code, F.lit(9)))
    return _one_of([date, some, article], variant)


def _example(before: Column, text: Column, after: Column, kind: str) -> Column:
    """The candidates that the generator of the kind proposes in this place."""
    padded = F.concat(before, text, after)
    inside = lambda c: (c["span"]["start"] < F.length(before) + F.length(text)) & (c["span"]["end"] > F.length(before))
    return F.filter(candidates(padded, kind), lambda c: inside(c) & ~c["held"])


def examples(found: DataFrame) -> DataFrame:
    """``fold, positive`` and the description of every example, from rows of ``scanned``."""
    out = []
    ways = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v")
    for kind in KINDS:
        near = found.select("fold", F.explode(f"valid_{kind}").alias("m")).select("fold", "m", ways)
        copy = near.select("fold", F.col("m.before").alias("before"), corrupted(kind, F.col("m.text"), F.col("v")).alias("t"), F.col("m.after").alias("after"))
        place = [F.col("before"), F.col("t"), F.col("after")]
        every_kind = F.explode(F.concat(*[_example(*place, k) for k in KINDS])).alias("c")
        out.append(copy.select("fold", every_kind).select("fold", (F.col("c.kind") == KINDS.index(kind)).alias("positive"), "c"))
        variant = F.pmod(F.xxhash64("doc_id", F.lit(kind)), F.lit(VARIANTS))
        text = harmless(kind, F.col("doc_id"), variant).alias("t")
        far = found.select("fold", F.col("place.before").alias("before"), text, F.col("place.after").alias("after"))
        out.append(far.select("fold", F.lit(False).alias("positive"), F.explode(_example(*place, kind)).alias("c")))
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.select("fold", "positive", *[F.col("c")[n].alias(n) for n in FEATURES])


@dataclass
class Detector:
    """``recall`` is that of out-of-fold examples per kind at the threshold."""

    model: Boosted
    cuts: dict[str, float]
    recall: dict[str, float]

    def accepts(self, c: Column) -> Column:
        names = list(FEATURES)
        cut = F.element_at(F.array(*[F.lit(self.cuts[k]) for k in KINDS]), c["kind"] + 1)
        return self.model.column(lambda k: c[names[k]]) >= cut


def balanced(cells: list[Cell]) -> list[Cell]:
    """Cells whose negatives weigh as much as their positives in every kind."""
    out = []
    for kind in range(len(KINDS)):
        own = [c for c in cells if c.codes[0] == kind]
        positive, n = sum(c.positive for c in own), sum(c.n for c in own)
        share = positive / (n - positive) if n > positive else 1.0
        out += [Cell(c.codes, c.positive + (c.n - c.positive) * share, c.positive) for c in own]
    return [c for c in out if c.n > 0]


def train(found: DataFrame) -> Detector:
    """Counts the descriptions of all examples and fits the trees."""
    names = list(FEATURES)
    counted = examples(found).groupBy("fold", *names).agg(F.count("*").alias("n"), F.count_if("positive").alias("p"))
    folds: dict[int, list[Cell]] = {}
    for r in counted.orderBy("fold", *names).collect():  # at most FOLDS times CELLS rows
        folds.setdefault(r["fold"], []).append(Cell(tuple(r[n] for n in names), r["n"], r["p"]))
    folds = {k: balanced(cells) for k, cells in folds.items()}
    scored = out_of_fold(folds, SIZES, **FIT) if len(folds) > 1 else []
    cuts, recall = {}, {}
    for k, kind in enumerate(KINDS):
        own = [(score, c) for score, c in scored if c.codes[0] == k]
        cuts[kind] = threshold(own, PRECISION)
        all_ = sum(c.positive for _, c in own)
        recall[kind] = sum(c.positive for score, c in own if score >= cuts[kind]) / all_ if all_ else 0.0
    cells = merged(c for held in folds.values() for c in held)
    return Detector(boost(cells, SIZES, **FIT), cuts, recall)


def scanned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans, candidates, validated matches with their surroundings, and a random place of every text; written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    at = F.pmod(F.xxhash64(F.col(id_col), F.lit("place")), F.length(text) + 1).cast("int")
    place = F.struct(
        F.substring(text, F.greatest(at - WINDOW + 1, F.lit(1)), F.least(at, F.lit(WINDOW))).alias("before"),
        F.substring(text, at + 1, F.lit(1)).alias("after"),
    )
    named = docs.where(F.col(id_col).isNotNull())
    rows = named.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *[base_matches(text, k).alias(f"valid_{k}") for k in KINDS],
        F.concat(*[candidates(text, k) for k in KINDS]).alias("candidates"),
        place.alias("place"),
    )
    base = F.concat(*[_spans(F.col(f"valid_{k}"), k) for k in KINDS])
    fold = (F.crc32(F.col("doc_id").cast("string")) % FOLDS).cast("int")
    return materialize(rows.withColumns({"base": F.array_sort(base), "fold": fold}), "pii-candidates")


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of ``start, rank, end, kind`` in order of start and kind."""
    return with_added(found := scanned(docs, id_col=id_col, text_col=text_col), train(found))


def with_added(found: DataFrame, detector: Detector) -> DataFrame:
    clear = lambda c: ~F.exists("base", lambda s: (s["start"] < c["span"]["end"]) & (c["span"]["start"] < s["end"]))
    open_ = found.select("doc_id", "base", F.filter("candidates", lambda c: ~c["held"] & clear(c)).alias("open"))
    added = F.transform(F.filter("open", detector.accepts), lambda c: c["span"])
    return open_.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by the kind of its first span."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(state, s):
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        mark = F.when(s["start"] >= state["at"], F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(
            F.concat(state["out"], mark).alias("out"), F.greatest(state["at"], s["end"]).alias("at")
        )

    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(spans, begin, step, rest)
