"""The feature generator: shape, shares, and a signal that can be learned."""

from pyspark.sql import functions as F

from cohortfit.functions.boosting import FitSpec
from cohortfit.plans.train import train_groups
from cohortfit.schemas import Roles
from cohortfit.sources import synthetic
from cohortfit.sources.tables import model_stats


def test_generated_table(spark):
    groups = synthetic.group_list(spark)
    assert [r[0] for r in groups.collect()] == [f"group_{i:02d}" for i in range(1, 11)]
    table = synthetic.feature_table(synthetic.base_rows(groups.where("group_name < 'group_04'"), 1000)).cache()
    assert table.columns == [
        "group_name",
        "label",
        "categorical_feature_01",
        *[f"numeric_feature_{i:02d}" for i in range(2, 21)],
        "id",
    ]
    assert table.count() == 3000 and table.select("id").distinct().count() == 3000
    numerics = [c for c in table.columns if "numeric" in c]
    missing = table.select([F.avg(F.col(c).isNull().cast("double")).alias(c) for c in numerics]).first()
    assert all(0.03 < v < 0.07 for v in missing)
    assert table.where("group_name is null or label is null").count() == 0
    codes = {r[0]: r[1] for r in table.groupBy("categorical_feature_01").count().collect()}
    assert set(codes) == {0, 1, 2, 3, None} and all(600 < codes[k] < 800 for k in range(4))
    true_class = synthetic.unflipped_class(11, F.col("group_name"), F.col("id"))
    flipped = table.where(F.col("label") != true_class).count() / 3000
    assert 0.17 < flipped < 0.23
    # Repeating the generation gives the same cells.
    again = synthetic.feature_table(synthetic.base_rows(groups.where("group_name < 'group_04'"), 1000))
    assert table.exceptAll(again).isEmpty()
    stats = model_stats(train_groups(table, Roles.from_names(table), FitSpec(n_estimators=20, max_depth=4)), "group_name")
    assert all(r["test_auc"] > 0.6 for r in stats.collect())
