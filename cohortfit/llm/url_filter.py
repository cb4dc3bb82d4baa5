"""URL filters: rules first, boosted trees on lexical features for what no rule decides.

A rule names a host and the beginning of a path; it fits its host and all subdomains, and
the longest fitting rule wins. URLs that a rule decides are the labelled ones (others can be
given besides): gradient-boosted trees learn from them how blocked URLs look, and judge
those that no rule fits. The features are the length, the depth, the share of digits, the
entropy of the characters, the number of parameters, and statistics of the host's last
label, its last two labels and the first part of the path: the share of labelled URLs with
this suffix that are blocked, hashed to ``PLACES`` places each, so the table has a fixed
size and no URL is shuffled to meet it. A labelled URL sees the statistics of the other
folds only (copies of a URL share a fold). The score from which up a URL is blocked is the lowest one
at which out-of-fold precision reaches ``PRECISION``.

Everything is DataFrame functions: URLs are read once and written with their codes; labelled
ones are counted per description, of which there are at most ``CELLS`` a fold; the fit takes
these counts, and the trees come back as CASE expressions.

Defined results: a NULL URL, or one without ``://``, has an empty host and path, fits no rule
and is judged by the trees like any other; the host is the text up to ``/``, ``?``, ``#`` or
the end, with A-Z in lower case, so a port or user name belongs to it; a path keeps its case.
Of fitting rules of equal length the one with the longer host wins, then the one that blocks.
Without a blocked or without an allowed labelled URL, all others get the verdict of those
there are (allow, if there are none). Repeated rows give repeated results, rows with a NULL
id are kept, long URLs are read whole, an empty table gives none. Only the two columns named
are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize
from cohortfit.llm.cell_trees import Boosted, Cell, boost, merged, out_of_fold, threshold

#: Hashed places per suffix statistic, folds of labelled hosts, wanted share of right blocks.
PLACES, FOLDS, PRECISION = 1024, 3, 0.9

#: Upper ends of the codes of a feature; values above the last end take one code more.
ENDS = {
    "length": (32, 42, 60),
    "depth": (1, 2, 3),
    "digits": (0.0, 0.08, 0.16),
    "entropy": (3.6, 3.9, 4.2),
    "params": (0, 1),
}
SUFFIXES = ("tld", "domain", "section")
#: Codes of a suffix: not seen, then by the share of blocked URLs up to these ends.
SHARES = (0.1, 0.5, 0.9)
SIZES = [*(len(ends) + 1 for ends in ENDS.values()), *[len(SHARES) + 2] * len(SUFFIXES)]
#: Descriptions there can be: 96,000, some 20 MB as rows on the driver for each fold.
CELLS = 4 * 4 * 4 * 4 * 3 * 5**3

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Characters counted one by one for the entropy; all others count as one.
COUNTED = LOWER + DIGITS + "-._/:?=&%#"


@dataclass(frozen=True)
class Rule:
    block: bool
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def first_fitting(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.block)):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.block).otherwise(verdict)
    return name, verdict


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = after_scheme(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def entropy(text: Column) -> Column:
    """Bits per character over the counted characters and one class for all others; 0 for an empty text."""
    chars = F.split(F.lit(COUNTED), "")
    counts = F.transform(chars, lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
    counts = F.concat(counts, F.array(F.length(F.translate(text, COUNTED, ""))))
    weighed = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n * F.log2(F.greatest(n, F.lit(1)).cast("double")))
    length = F.length(text)
    return F.when(length > 0, F.log2(length.cast("double")) - weighed / length).otherwise(0.0)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    length = F.length(text)
    query = F.regexp_extract(after_scheme(text), r"^[^?#]*+\?([^#]*+)", 1)
    return {
        "length": length,
        "depth": F.length(F.regexp_replace(path, "[^/]++|/++$", "")),
        "digits": F.when(length > 0, _count(text, DIGITS) / length).otherwise(0.0),
        "entropy": entropy(F.translate(text, UPPER, LOWER)),
        "params": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
    }


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    named = F.regexp_replace(host, r":[0-9]*+$", "")
    section = F.regexp_extract(path, "^/([^/]*+)", 1)
    return {"tld": F.substring_index(named, ".", -1), "domain": F.substring_index(named, ".", -2), "section": section}


def _code(value: Column, ends: tuple) -> Column:
    out = F.lit(len(ends))
    for k in range(len(ends) - 1, -1, -1):
        out = F.when(value <= ends[k], k).otherwise(out)
    return out


def described(urls: DataFrame, url: Column, rules: list[Rule], given: Column) -> DataFrame:
    """Host, path, rule, label (``blocked``), fold, the codes of the features, and the places of the suffixes."""
    host, path = host_and_path(url)
    rows = urls.withColumns({"host": host, "path": path})
    host, path = F.col("host"), F.col("path")
    name, ruled = first_fitting(rules, host, path)
    measured = features(url, host, path)
    rows = rows.withColumns({f"v_{k}": v for k, v in measured.items()})
    codes = {f"f_{k}": _code(F.col(f"v_{k}"), ENDS[k]) for k in measured}
    places = {f"s_{k}": F.pmod(F.xxhash64(v), F.lit(PLACES)).cast("int") for k, v in suffixes(host, path).items()}
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.coalesce(url, F.lit(""))), F.lit(FOLDS)).cast("int")
    rows = rows.withColumns({"rule": name, "ruled": ruled, "blocked": F.coalesce(ruled, given), "fold": fold} | codes | places)
    return rows.drop(*[f"v_{k}" for k in measured])


@dataclass(frozen=True)
class Statistics:
    """Codes of the places of every suffix: without one fold after the other, then over all folds."""

    codes: dict[str, list[int]]

    @classmethod
    def counted(cls, rows: DataFrame) -> Statistics:
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"s_{k}").alias("place")) for k in SUFFIXES]))
        labelled = rows.where("blocked is not null").select("fold", "blocked", each.alias("s"))
        counts = labelled.groupBy("fold", "s.k", "s.place").agg(F.count("*").alias("n"), F.count_if("blocked").alias("p"))
        sums = {k: [[0, 0] for _ in range(PLACES * (FOLDS + 1))] for k in SUFFIXES}
        for r in counts.collect():  # at most suffixes x places x folds rows
            for without in range(FOLDS + 1):
                if without != r["fold"]:
                    held = sums[r["k"]][without * PLACES + r["place"]]
                    held[0] += r["n"]
                    held[1] += r["p"]
        return cls({k: [cls._of(n, p) for n, p in held] for k, held in sums.items()})

    @staticmethod
    def _of(n: int, p: int) -> int:
        return 0 if not n else 1 + next((k for k, end in enumerate(SHARES) if p <= end * n), len(SHARES))

    def code(self, suffix: str, fold: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.codes[suffix]))), ",").cast("array<int>")
        return F.get(table, fold * PLACES + F.col(f"s_{suffix}"))

    def attached(self, rows: DataFrame, fold: Column) -> DataFrame:
        """``rows`` with the codes of all features as ``c0, c1, ...``."""
        columns = [*[F.col(f"f_{k}") for k in ENDS], *[self.code(k, fold) for k in SUFFIXES]]
        return rows.withColumns({f"c{k}": c for k, c in enumerate(columns)})


@dataclass(frozen=True)
class UrlModel:
    statistics: Statistics
    trees: Boosted
    cut: float

    def scored(self, rows: DataFrame) -> DataFrame:
        """Rows of ``described`` with their ``score``."""
        coded = self.statistics.attached(rows, F.lit(FOLDS))
        return coded.withColumn("score", self.trees.column(lambda k: F.col(f"c{k}")))


def train(rows: DataFrame) -> UrlModel:
    """Fits the trees on the labelled rows of ``described``."""
    statistics = Statistics.counted(rows)
    names = [f"c{k}" for k in range(len(SIZES))]
    labelled = statistics.attached(rows.where("blocked is not null"), F.col("fold"))
    counted = labelled.groupBy("fold", *names)
    folds: dict[int, list[Cell]] = {}
    for r in counted.agg(F.count("*").alias("n"), F.count_if("blocked").alias("p")).orderBy("fold", *names).collect():
        folds.setdefault(r["fold"], []).append(Cell(tuple(r[n] for n in names), r["n"], r["p"]))
    cells = merged(c for held in folds.values() for c in held)
    n, p = sum(c.n for c in cells), sum(c.positive for c in cells)
    if p in (0, n):
        return UrlModel(statistics, boost(cells, SIZES), 0.0 if p else 2.0)
    return UrlModel(statistics, boost(cells, SIZES), threshold(out_of_fold(folds, SIZES), PRECISION))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    blocked: Column | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row.

    ``blocked`` labels URLs that no rule fits: true, false, or NULL for those to be judged.
    ``score`` is that of the trees, also where a rule decides.
    """
    given = F.lit(None).cast("boolean") if blocked is None else blocked
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), given.alias("given"))
    rows = described(chosen, F.col("url"), rules, F.col("given")).drop("url", "given")
    rows = materialize(rows, "url-codes")
    model = train(rows)
    blocks = F.coalesce("ruled", F.col("score") >= model.cut)
    return model.scored(rows).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(blocks, "block").otherwise("allow").alias("verdict"),
        F.round("score", 6).alias("score"),
    )
