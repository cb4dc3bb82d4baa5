"""How often queries build their rows, and what a fit holds per row."""

import functools
import tracemalloc

import numpy as np
import pandas as pd

from cohortfit.functions import boosting as B
from cohortfit.operators.encode import encoder_stats
from cohortfit.operators.fit import ROW_BYTES, GroupData
from cohortfit.plans import catalog


def test_categories_build_the_masked_orders_once(spark, sf, monkeypatch):
    """However often the encoders read them: once for the sizes, once to be written."""
    built, orders = spark.sparkContext.accumulator(0), catalog.masked_orders

    def seen(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    def counted(spark, folder):
        rows = orders(spark, folder)
        return rows.mapInArrow(seen, rows.schema)

    want = sorted(map(tuple, catalog.onehot_train_categories(spark, sf).collect()))
    monkeypatch.setattr(catalog, "masked_orders", counted)
    monkeypatch.setattr(catalog, "encoder_stats", functools.partial(encoder_stats, cells=200))  # medians by brackets
    assert sorted(map(tuple, catalog.onehot_train_categories(spark, sf).collect())) == want
    assert built.value <= 2 * orders(spark, sf).count()


def test_a_fit_holds_few_bytes_a_row():
    """Bins a few times over and some numbers per row, never the values as objects."""
    width, random = 25, np.random.default_rng(3)

    def peak(rows):
        x = random.integers(0, 200, (width, rows)).astype(np.uint8)
        label = (x[0] > 90).astype(float)
        parts = [(rows * 2 // 3, False, slice(0, rows * 2 // 3)), (rows - rows * 2 // 3, True, slice(rows * 2 // 3, rows))]
        records = [
            (test, n, x[:, at].tobytes(), label[at].tobytes(), np.arange(n, dtype=np.uint32).tobytes()) for n, test, at in parts
        ]
        records = pd.DataFrame(records, columns=["is_test", "n", "bins", "label", "row_hash"])
        tracemalloc.start()
        data = GroupData(records, [np.arange(200.0)] * width, 256)
        data.fit(B.FitSpec(n_estimators=2, max_depth=8, subsample=0.7, random_state=1), 0, {})
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    small, large = peak(100_000), peak(300_000)
    assert (large - small) / 200_000 < 3 * width + 2 * ROW_BYTES
