"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int = 8, app: str = "cohortfit", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="cohortfit-")
    return _local_folders[application]


@dataclass(frozen=True)
class Saved:
    """A frame written to the shared folder, and the place to free it."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        spark = self.df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def save(df: DataFrame, name: str) -> Saved:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cached frame the result outlives any executor, and unlike an RDD
    checkpoint it keeps column pruning, pushdown and file-size statistics.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cohortfit/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    saved = Saved(spark.read.schema(df.schema).parquet(path), path)
    if _open_scratch:
        _open_scratch[-1].append(saved)
    return saved


_open_scratch: list[list[Saved]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Free every frame saved inside the block when it ends.

    For flows that write their results to tables of their own before they return.
    """
    _open_scratch.append([])
    try:
        yield
    finally:
        for saved in _open_scratch.pop():
            saved.drop()


def materialize(df: DataFrame, name: str) -> DataFrame:
    return save(df, name).df
