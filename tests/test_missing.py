"""NaN counts as a missing value, in small and in large groups."""

from cohortfit.operators.encode import encoder_stats, impute
from cohortfit.schemas import Roles


def test_nan_is_imputed(spark):
    rows = [("a", k, k % 2, float("nan") if k % 3 == 0 else float(k)) for k in range(12)]
    table = spark.createDataFrame(rows, "group_name string, id long, label int, numeric_01 double")
    roles = Roles.from_names(table)
    for cells in (1_000_000, 4):
        stats = encoder_stats(table, roles, cells=cells)
        assert stats.first()["medians"] == [6.0]
        filled = impute(table.join(stats, "group_name"), roles).select("numeric_01").collect()
        assert sorted(r[0] for r in filled) == sorted(6.0 if k % 3 == 0 else float(k) for k in range(12))
