"""Quantiles, splits and AUC: the split-up path for hot groups against brute force."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortfit.functions import boosting as B
from cohortfit.operators.evaluate import group_auc
from cohortfit.operators.groups import attach, measure, ranked_within, search_sorted
from cohortfit.operators.quantiles import group_medians, group_quantiles, quartile_bins
from cohortfit.operators.split import train_test_split

from data import skewed, to_spark

SCHEMA = "g string, x double, z double, y int, id long"


@pytest.fixture(scope="module")
def pdf():
    return skewed()


@pytest.fixture(scope="module")
def df(spark, pdf):
    return to_spark(spark, pdf, SCHEMA).repartition(6).cache()


@pytest.mark.parametrize("cells", [10**6, 100])
def test_quantiles_match_brute_force(df, pdf, cells):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in group_quantiles(df, "g", ["x", "z"], probs, cells=cells).collect()}
    for name, part in pdf.groupby("g", dropna=False):
        row = got[None if pd.isna(name) else name]
        for column in ("x", "z"):
            known = part[column].astype(float).dropna()
            if len(known) == 0:
                assert row[column] is None
            else:
                assert np.allclose(row[column], np.quantile(known, probs), rtol=0, atol=1e-9)


def test_quantile_brackets_widen_until_they_hold_the_rank(spark):
    """One value repeated most of the time leaves sketch brackets off the mark."""
    values = [(("a"), 1.0)] * 500 + [("a", float(v)) for v in range(2, 400)]
    frame = spark.createDataFrame(values, "g string, x double")
    row = group_quantiles(frame, "g", ["x"], [0.5, 0.561, 0.9], cells=10).first()
    assert np.allclose(row["x"], np.quantile([v for _, v in values], [0.5, 0.561, 0.9]), atol=1e-9)


@pytest.mark.parametrize("cells", [10**6, 100])
def test_quartile_bins_and_medians(df, pdf, cells):
    bins = quartile_bins(df, "g", "x", "q", cells=cells).toPandas()
    for _, part in bins.groupby("g", dropna=False):
        known = part["x"].dropna()
        if known.nunique() < 8:
            continue
        cuts = np.quantile(known, [0.25, 0.5, 0.75])
        expected = np.searchsorted(cuts, known, side="left")
        assert (part.loc[known.index, "q"].astype(int).to_numpy() == expected).all()
    assert bins[bins["x"].isna()]["q"].isna().all()
    medians = {r["g"]: r["z"] for r in group_medians(df, "g", ["z"], cells=cells).collect()}
    for name, part in pdf.groupby("g", dropna=False):
        assert math.isclose(medians[None if pd.isna(name) else name], part["z"].median(), abs_tol=1e-12)


@pytest.mark.parametrize("limits", [{}, {"task_rows": 20}, {"shuffle_rows": 10}])
def test_split_matches_brute_force(df, pdf, limits):
    got = {r["id"]: r["split"] for r in train_test_split(df, "g", "id", **limits).collect()}
    assert len(got) == len(pdf)
    for _, part in pdf.groupby("g", dropna=False):
        order = sorted(part["id"], key=lambda i: (hashlib.md5(f"123:{i}".encode()).hexdigest(), i))
        cut = math.ceil(0.33 * len(order))
        assert {i for i in order[:cut]} == {i for i in order if got[i] == "test"}


def test_split_of_repeated_ids_does_not_depend_on_size(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("a")).alias("g"), (F.col("id") % 10).alias("id"), F.hash("id").alias("x")
    )
    got = [
        sorted((str(r["g"]), r["id"], r["x"], r["split"]) for r in train_test_split(rows, "g", "id", **limits).collect())
        for limits in ({}, {"task_rows": 20}, {"shuffle_rows": 10})
    ]
    assert got[0] == got[1] == got[2]
    for name in ("a", "None"):
        part = [r for r in got[0] if r[0] == name]
        assert sum(r[3] == "test" for r in part) == math.ceil(0.33 * len(part))


def test_large_split_does_not_shuffle_the_rows(df):
    plan = train_test_split(df, "g", "id", task_rows=20)._jdf.queryExecution().executedPlan().toString()
    spine = [line for line in plan.splitlines() if "Window" in line]
    assert all("x#" not in line for line in spine)


@pytest.mark.parametrize("task_rows", [10**6, 25])
def test_auc_matches_pair_count(df, pdf, task_rows):
    got = {r["g"]: r["auc"] for r in group_auc(df, "g", "y", "x", task_rows=task_rows).collect()}
    for name, part in pdf.groupby("g", dropna=False):
        part = part[part["x"].notna()]
        pos, neg = part[part["y"] == 1]["x"].to_numpy(float), part[part["y"] == 0]["x"].to_numpy(float)
        key = None if pd.isna(name) else name
        if len(pos) == 0 or len(neg) == 0:
            assert got.get(key) is None
        else:
            wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
            assert got[key] == wins / (len(pos) * len(neg))


def test_ranked_within_is_the_same_on_both_paths(df):
    sizes = measure(df, "g")
    unique = df.where("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    whole = ranked_within(unique, ["g"], "x", {"before": "n"}, sizes).collect()
    parts = ranked_within(unique, ["g"], "x", {"before": "n"}, sizes, task_rows=15).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))


def test_attach_gives_the_same_rows_broadcast_or_salted(df):
    stats = df.groupBy("g").agg(F.max("z").alias("top"))
    small = attach(df, stats, ["g"], stats_rows=5, row_bytes=16)
    salted = attach(df, stats, ["g"], stats_rows=5, row_bytes=16, broadcast_bytes=0, hot_rows=500)
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    assert small.count() == salted.count() == df.count()
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_search_sorted_counts_smaller_cuts(spark):
    cuts = [1.0, 2.0, 2.5, 7.0, 9.0]
    frame = spark.createDataFrame([(v / 2,) for v in range(-2, 22)], "v double")
    found = frame.select("v", search_sorted(F.array(*[F.lit(c) for c in cuts]), F.col("v"), 8).alias("i")).collect()
    assert all(r["i"] == sum(c < r["v"] for c in cuts) for r in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), min_size=2, max_size=60))
def test_auc_properties(pairs):
    y = np.array([p[0] for p in pairs], dtype=float)
    s = np.array([p[1] for p in pairs], dtype=float)
    value = B.auc(y, s)
    if value is None:
        assert y.min() == y.max()
        return
    assert 0.0 <= value <= 1.0
    assert B.auc(y, 3 * s + 1) == value
    assert math.isclose(B.auc(1 - y, s), 1 - value, abs_tol=1e-12)
