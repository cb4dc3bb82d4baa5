"""Cases that once failed: sizes given for another table, trials without a loss, NaN, equal rows, one-task generation."""

import numpy as np
from pyspark.sql import functions as F

from cohortfit.functions import boosting as B
from cohortfit.functions.trees import FlatTrees, feature_matrix
from cohortfit.operators.fit import fit_groups
from cohortfit.operators.groups import Sizes, attach, numbered
from cohortfit.operators.quantiles import quartile_bins
from cohortfit.operators.score import tree_margins
from cohortfit.operators.tune import search_progress
from cohortfit.sources.synthetic import base_rows, group_list, name_groups

SPEC = B.FitSpec(n_estimators=2, max_depth=2, max_bins=8)


def encoded(spark, n):
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        "id",
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.array((F.col("id") % 7).cast("double"), (F.col("id") % 2 + F.col("id") % 11 / 9).cast("double")).alias("features"),
    )
    return rows


def test_no_hot_group_is_left(spark):
    """The sizes are those of a wider table: nothing here exceeds the limit."""
    trials = spark.createDataFrame([("a", 0, {}), ("b", 0, {})], "g string, trial_id int, params map<string,double>")
    fitted = fit_groups(encoded(spark, 60), trials, "g", spec=SPEC, sizes=Sizes(2, 10**7, 10**6), fit_rows=1000)
    assert sorted(r.g for r in fitted.collect()) == ["a", "b"]
    only_small = trials.where("g = 'a'")
    fitted = fit_groups(encoded(spark, 60), only_small, "g", spec=SPEC, fit_rows=30)  # b has 40 rows and no trial
    assert [r.g for r in fitted.collect()] == ["a"]


def test_trials_without_a_loss_stop_the_search(spark):
    rows = [("x", t, None) for t in range(60)] + [("y", t, 0.5 if t == 40 else None) for t in range(60)]
    got = {r.g: r for r in search_progress(spark.createDataFrame(rows, "g string, trial_id long, loss double"), "g", patience=25).collect()}
    assert (got["x"].stopped_at, got["x"].best_loss) == (24, None)
    assert got["y"].stopped_at == 24
    late = spark.createDataFrame([("y", 0, None), ("y", 1, 0.5), ("y", 2, 0.5)], "g string, trial_id long, loss double")
    row = search_progress(late, "g", patience=25).first()
    assert (row.best_loss, row.stale, row.stopped_at) == (0.5, 1, None)


def test_nan_has_no_quartile(spark):
    rows = [("a", float(k)) for k in range(1, 9)] + [("a", float("nan"))] * 4 + [("a", None)]
    table = spark.createDataFrame(rows, "g string, v double")
    for cells in (10**6, 4):
        got = quartile_bins(table, "g", "v", "q", cells=cells).collect()
        assert sorted((r.v, r.q) for r in got if r.v is not None and r.v == r.v) == [(float(k + 1), k // 2) for k in range(8)]
        assert [r.q for r in got if r.v is None or r.v != r.v] == [None] * 5


def test_equal_rows_of_a_hot_key_spread(spark):
    rows = spark.range(0, 40_000, 1, 16).select(F.lit("k").alias("g"), F.lit(1).alias("v"))
    stats = spark.createDataFrame([("k", 5)], "g string, s int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(rows, stats, ["g"], stats_rows=1, row_bytes=64, broadcast_bytes=0, hot_rows=1000)
        spread = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert joined.count() == 40_000 and joined.where("s = 5").count() == 40_000
    assert max(r["count"] for r in spread) < 40_000


def test_generator_fills_all_tasks(spark):
    rows = base_rows(group_list(spark, 3), 1000)
    sizes = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in sizes) < 1000
    got = rows.groupBy("group_name").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == [("group_01", 0, 999, 1000), ("group_02", 1000, 1999, 1000), ("group_03", 2000, 2999, 1000)]


def test_numbers_follow_the_key(spark):
    keys = spark.createDataFrame([(c,) for c in "hgfedcbaaz"], "k string").repartition(4)
    assert sorted((r.n, r.k) for r in numbered(keys, "k", "n").collect()) == list(enumerate(sorted("hgfedcbaaz")))
    named = name_groups(keys, "k").collect()
    assert {r.k: r.group_name for r in named} == {k: f"group_{i + 1:02d}" for i, k in enumerate(sorted(set("hgfedcbaaz")))}


TREES = "roots array<int>, node_feature array<int>, node_threshold array<double>, node_left array<int>, node_right array<int>, node_value array<double>, tree_depth int"


def forest(seed, trees, depth, width):
    """Full trees with random splits, and single leaves now and then."""
    r = np.random.default_rng(seed)
    out = {c: [] for c in ("roots", "node_feature", "node_threshold", "node_left", "node_right", "node_value")}

    def add(level):
        place = len(out["node_value"])
        for c in list(out)[1:]:
            out[c].append(-1)
        leaf = level == 0 or r.random() < 0.2
        out["node_feature"][place] = -1 if leaf else int(r.integers(width))
        out["node_threshold"][place], out["node_value"][place] = float(r.normal()), float(r.normal())
        if not leaf:
            out["node_left"][place], out["node_right"][place] = add(level - 1), add(level - 1)
        return place

    for _ in range(trees):
        out["roots"].append(add(depth))
    return out | {"tree_depth": depth}


def walked(model, x):
    total = 0.0
    for node in model["roots"]:
        while (f := model["node_feature"][node]) >= 0:
            low = f < len(x) and x[f] is not None and x[f] <= model["node_threshold"][node]
            node = model["node_left" if low else "node_right"][node]
        total += model["node_value"][node]
    return total


def test_batches_of_rows_walk_the_trees(spark):
    models = {"a": forest(1, 30, 5, 4), "b": forest(2, 1, 0, 4), None: forest(3, 7, 3, 4), "none": None}
    nothing = dict.fromkeys([*forest(1, 1, 1, 1)])
    table = spark.createDataFrame([(k, *(m or nothing).values()) for k, m in models.items()], "g string, " + TREES)
    r = np.random.default_rng(4)
    rows = []
    for k in range(400):
        x = [float(v) if r.random() > 0.1 else None for v in r.normal(size=4)]
        x = None if k == 7 else [] if k == 8 else x[: 2 + k % 3] if k % 50 == 0 else x
        rows.append((["a", "b", None, "none", "unknown"][k % 5], k, x))
    features = spark.createDataFrame(rows, "g string, id long, features array<double>").repartition(3)
    for options in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "score_rows": 10}):
        got = {x.id: x.margin for x in tree_margins(features, table, "g", **options).collect()}
        for g, k, x in rows:
            model = models.get(g)
            assert got[k] == (None if model is None else walked(model, x or []))
    assert tree_margins(features.limit(0), table, "g").count() == 0


def test_chunks_of_the_walk_agree(monkeypatch):
    from cohortfit.functions import trees

    model = FlatTrees.of(forest(5, 50, 6, 3))
    x = np.random.default_rng(6).normal(size=(500, 3))
    whole = model.margins(x)
    monkeypatch.setattr(trees, "WALK_CELLS", 700)
    assert (model.margins(x) == whole).all()
    import pyarrow as pa

    lists = pa.array([[1.0], None, [], [2.0, 3.0]], pa.list_(pa.float64()))
    assert np.array_equal(feature_matrix(lists, 2), [[1, np.nan], [np.nan] * 2, [np.nan] * 2, [2, 3]], equal_nan=True)
