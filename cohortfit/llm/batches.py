"""Bounded Arrow batches for the stages of these operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortfit import session

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that Spark hands to a Python worker at a time. Its own default is 64 MB,
#: held by the JVM and by the worker of every running task.
BATCH_BYTES = 4 << 20


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has already (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``session.materialize`` with batches of BATCH_BYTES, unless the session has a bound of its own."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is not None:
        return session.materialize(df, name)
    conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        return session.materialize(df, name)
    finally:
        conf.unset(BATCH_CONF)
