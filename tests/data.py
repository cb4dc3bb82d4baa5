"""Small fixtures with known content."""

import numpy as np
import pandas as pd


def skewed(seed=0, sizes=(("hot", 3000), ("mid", 60), ("two", 2), ("one", 1), (None, 40))):
    """Groups of very different size, one of them without a name; ties and NULLs in x."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, n in sizes:
        x = np.round(rng.gamma(2.0, 10.0, n), 1)
        x[rng.random(n) < 0.3] = 7.5
        parts.append(
            pd.DataFrame(
                {
                    "g": [name] * n,
                    "x": [None if rng.random() < 0.05 else float(v) for v in x],
                    "z": rng.normal(size=n),
                    "y": rng.integers(0, 2, n),
                }
            )
        )
    out = pd.concat(parts, ignore_index=True)
    out["id"] = np.arange(len(out))
    return out.sample(frac=1, random_state=seed).reset_index(drop=True)


def to_spark(spark, pdf, schema):
    rows = [
        tuple(None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in row)
        for row in pdf.astype(object).itertuples(index=False)
    ]
    return spark.createDataFrame(rows, schema)


def learnable(seed=1, groups=(("a", 300), ("b", 120), (None, 90))):
    """A separable signal with a different feature in each group, plus missing cells."""
    rng = np.random.default_rng(seed)
    parts = []
    for k, (name, n) in enumerate(groups):
        x = rng.normal(size=(n, 3))
        y = (x[:, k % 3] + 0.3 * rng.normal(size=n) > 0).astype(int)
        cat = np.where(x[:, k % 3] > 0.5, "high", rng.choice(["low", "mid"], n))
        frame = pd.DataFrame({"g": [name] * n, "label": y, "categorical_a": cat})
        for j in range(3):
            frame[f"numeric_{j}"] = [None if rng.random() < 0.05 else float(v) for v in x[:, j]]
        parts.append(frame)
    out = pd.concat(parts, ignore_index=True)
    out["id"] = np.arange(len(out))
    return out


LEARNABLE_SCHEMA = (
    "g string, label int, categorical_a string, numeric_0 double, numeric_1 double, numeric_2 double, id long"
)
