"""URL filters: rules by brute force, trees as expressions and as Python, accuracy on held-out URLs."""

import random
import re

from pyspark.sql import functions as F

from cohortfit.llm import cell_trees, url_filter
from cohortfit.llm.queries import URL_RULES
from cohortfit.llm.url_filter import Rule

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, fold int, c0 int"


def plain(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.name), len(r.host), r.block), default=None)
    return host, path, best


def urls():
    r = random.Random(1)
    hosts = ["example.com", "www.example.com", "m.www.example.com", "badexample.com", "a.NET", "net", "x.org", "ÄB.example.net", "com", "u@h.com:80"]
    tails = ["", "/", "/en", "/en/", "/en/a//b/?q=1&&r=2#top", "/es/x.html", "/fr/1?u=http://example.com/en/", "?x=/en/", "#/en/", "/EN/1"]
    out = [f"{s}://{h}{t}" for s in ("http", "HTTPS", "") for h in hosts for t in tails]
    out += [None, "", "://", "no scheme", "mailto:a@b", "http:/example.com/en/", "http://a\nb.com/\n", "x" * 200_000, "http://a.com/" + "1/" * 50_000 + "?" + "a=1&" * 9_000]
    out += [f"http://h{k}.example.net/{r.choice(['en', 'de', 'es', 'fr'])}/{r.randint(0, 9999)}.html" for k in range(80)]
    return out + out[:20]


def rows():
    out = [(k, u, "<p>", "h", "p", "r", 1, 1) for k, u in enumerate(urls())]
    return out + [(None, "http://www.example.com/en/1", None, None, None, None, None, None), out[3]]


def test_rules(spark):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    rules = [*URL_RULES, Rule(True, "net", "/es/x"), Rule(True, "h.com:80", "/"), Rule(False, "u@h.com:80", "/en")]
    got = url_filter.judge(pages, rules).collect()
    expected = sorted((str(r[0]), *plain(r[1], rules)[:2], str((b := plain(r[1], rules)[2]) and b.name)) for r in rows())
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == expected
    verdicts = {r.name: "block" if r.block else "allow" for r in rules}
    assert all(r.verdict == verdicts[r.rule] for r in got if r.rule)
    assert {r.verdict for r in got} == {"allow", "block"}


def test_trees_as_expressions(spark):
    pages = spark.createDataFrame(rows(), SCHEMA)
    coded = url_filter.described(pages.select("page_id", "url"), F.col("url"), URL_RULES, F.lit(None).cast("boolean"))
    coded = coded.cache()
    model = url_filter.train(coded)
    assert model.trees.trees
    for r in model.scored(coded).collect():
        codes = tuple(r[f"c{k}"] for k in range(len(url_filter.SIZES)))
        assert all(0 <= c < n for c, n in zip(codes, url_filter.SIZES))
        assert abs(model.trees.score(codes) - r.score) < 1e-9


def test_held_out_urls(spark):
    """Labels that depend on the features, learned from two thirds of the URLs."""
    r = random.Random(2)
    made = []
    for k in range(1500):
        spam = r.random() < 0.3
        host = f"{'win' if spam else 'news'}{r.randint(1, 60)}.{r.choice(['biz', 'info']) if spam else 'org'}"
        query = "&".join(f"id{j}={r.randint(10**6, 10**9)}" for j in range(r.randint(2, 4))) if spam else ""
        made.append((k, f"https://{host}/{r.randint(1, 30)}/page?{query}", spam))
    pages = spark.createDataFrame(made, "page_id long, url string, spam boolean")
    held_out = F.col("page_id") % 3 == 0
    got = url_filter.judge(pages, [], blocked=F.when(~held_out, F.col("spam")))
    verdict = {x.page_id: x.verdict == "block" for x in got.collect()}
    held = [(verdict[k], spam) for k, _, spam in made if k % 3 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_one_verdict_or_none(spark):
    pages = spark.createDataFrame(rows()[:30], SCHEMA)
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(pages, [Rule(True, "com")]).collect()} == {"block"}
    none = url_filter.judge(spark.createDataFrame([], SCHEMA), URL_RULES)
    assert none.columns == ["page_id", "host", "path", "rule", "verdict", "score"] and none.count() == 0


def test_cells_keep_counts():
    cells = [cell_trees.Cell((0, 1), 3, 1), cell_trees.Cell((0, 1), 2, 2), cell_trees.Cell((1, 0), 5, 0)]
    assert cell_trees.merged(cells) == [cell_trees.Cell((0, 1), 5, 3), cell_trees.Cell((1, 0), 5, 0)]
    assert cell_trees.threshold([(0.9, cell_trees.Cell((0,), 50, 50)), (0.5, cell_trees.Cell((1,), 50, 0))], 0.9) == 0.7
