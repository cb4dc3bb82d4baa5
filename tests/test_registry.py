"""Runs, versions and stages as events."""

import pytest

from cohortfit.operators import registry as R
from cohortfit.sources.store import Store


def test_store_creates_once_and_numbers_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first, again = store.open_run("e", "r", "1"), store.open_run("e", "r", "1")
    other = store.open_run("e", "r", "2")
    assert first == again != other
    assert store.read("experiments").count() == 1 and store.read("runs").count() == 2
    assert [store.register("m", run) for run in (first, other, first)] == [1, 2, 3]
    assert store.register("n", first) == 1
    assert store.read("names").count() == 2


def test_promotion_archives_the_previous_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    runs = [store.open_run("e", "r", t) for t in "123"]
    for run in runs:
        store.register("m", run)
    store.transition("m", 1)
    store.transition("m", 3)
    stages = {r["version"]: r["stage"] for r in store.current().collect()}
    assert stages == {1: R.ARCHIVED, 2: R.NONE, 3: R.PRODUCTION}
    store.transition("m", 1)
    stages = {r["version"]: r["stage"] for r in store.current().collect()}
    assert stages == {1: R.PRODUCTION, 2: R.NONE, 3: R.ARCHIVED}
    assert R.resolve_one(store.current(), "m") == (1, runs[0], f"runs/{runs[0]}/models")
    store.transition("m", 1, R.ARCHIVED)
    with pytest.raises(LookupError, match="'m'"):
        R.resolve_one(store.current(), "m")


@pytest.mark.parametrize("task_rows", [1000, 5])
def test_many_requests_of_one_name(spark, task_rows):
    requests = spark.range(200).selectExpr(
        "id * 3 as seq", "if(id % 4 = 0, 'b', 'a') as name", "'r' as run_id", "'s' as source"
    )
    versions = spark.createDataFrame([("a", 7)], "name string, version int")
    rows = R.next_versions(versions, requests, task_rows=task_rows).collect()
    for name, start in (("a", 8), ("b", 1)):
        mine = sorted((r["seq"], r["version"]) for r in rows if r["name"] == name)
        assert [v for _, v in mine] == list(range(start, start + len(mine)))
