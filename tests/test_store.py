"""The project's tables: named column models, result rows, what a missing and a damaged table are."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortfit.operators.fit import cpu_profile
from cohortfit.sources.store import Store


def test_named_column_models(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.add_column_model("scaled", "x * 3") == 1
    assert store.add_column_model("scaled", "coalesce(x, 0) / 4") == 2
    assert store.add_column_model("other", "-x") == 1
    rows = spark.createDataFrame([(8,), (None,)], "v int")
    values = lambda f: [r[0] for r in rows.select(f(F.col("v"))).collect()]
    later = Store(spark, str(tmp_path / "store"))  # another session would see the same
    assert values(later.column_model("scaled")) == [2.0, 0.0]
    assert values(later.column_model("scaled", 1)) == [24.0, None]
    assert values(later.column_model("other")) == [-8.0, None]
    assert spark.sql("SELECT scaled_v1(2)").first()[0] == 6.0
    with pytest.raises(LookupError):
        store.column_model("unknown")
    with pytest.raises(LookupError):
        store.column_model("scaled", 9)
    with pytest.raises(ValueError):
        store.add_column_model("a b", "x")
    with pytest.raises(AnalysisException):
        store.add_column_model("broken", "y + 1")


def test_only_a_missing_table_is_empty(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.read("versions").count() == 0
    with pytest.raises(AnalysisException):
        store.read("models")
    assert store.register("m", "run-1") == 1 and store.register("m", "run-2") == 2
    for file in os.listdir(store.path("versions")):
        if file.endswith(".parquet"):
            with open(os.path.join(store.path("versions"), file), "wb") as out:
                out.write(b"damaged")
    with pytest.raises(Exception):
        store.register("m", "run-3")


def test_result_rows_are_read_back_by_run(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for run, n in (("r1", 2), ("it's r2", 3)):
        rows = spark.range(n).select(F.concat(F.lit("g"), "id").alias("group"), F.lit(run).alias("run_id"), F.lit(0.5).alias("test_auc"))
        store.add_stats(rows)
    assert store.stats("r1").count() == 2 and store.stats("it's r2").count() == 3 and store.stats("r3").count() == 0


def test_cores_are_not_reserved_in_a_local_session(spark):
    assert cpu_profile(spark, 4) is None and cpu_profile(spark, None) is None
