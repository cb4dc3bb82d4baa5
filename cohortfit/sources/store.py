"""The project's own tables: experiments, runs, trials, models, versions, stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortfit.operators import registry
from cohortfit.operators.groups import Sizes
from cohortfit.schemas import EXEC_FIELDS, TREE_FIELDS, struct_of

TEXT, DOUBLES = T.StringType(), T.ArrayType(T.DoubleType())
NAMED_DOUBLES = T.MapType(T.StringType(), T.DoubleType())

TABLES = {
    "experiments": struct_of(("experiment", TEXT)),
    "runs": struct_of(("run_id", TEXT), ("experiment", TEXT), ("run_name", TEXT)),
    "names": struct_of(("name", TEXT)),
    "versions": struct_of(
        ("seq", T.LongType()), ("name", TEXT), ("version", T.IntegerType()), ("run_id", TEXT), ("source", TEXT)
    ),
    "transitions": struct_of(
        ("seq", T.LongType()), ("name", TEXT), ("version", T.IntegerType()), ("stage", TEXT)
    ),
    "column_models": struct_of(("name", TEXT), ("version", T.IntegerType()), ("expression", TEXT)),
}

MODEL_FIELDS = (
    ("best_trial", T.IntegerType()),
    ("params", NAMED_DOUBLES),
    ("metrics", NAMED_DOUBLES),
    ("medians", DOUBLES),
    *TREE_FIELDS,
    *EXEC_FIELDS,
)


class Store:
    """Append-only Parquet tables under one shared folder.

    ``models`` and ``trials`` are partitioned by run, so scoring a run reads only
    that run's folder.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def append(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        if table in TABLES:
            rows = rows.select(*TABLES[table].fieldNames())
        writer = rows.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        try:
            reader = self.spark.read
            return (reader.schema(TABLES[table]) if table in TABLES else reader).parquet(self.path(table))
        except AnalysisException as error:
            # Only a table that was never written is empty; a damaged one is an error.
            if table not in TABLES or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TABLES[table])

    def open_run(self, experiment: str, run_name: str, token: str) -> str:
        """Create the experiment if missing, then a run; the id repeats for equal inputs."""
        wanted = self.spark.createDataFrame([(experiment,)], TABLES["experiments"])
        self.append("experiments", registry.missing_rows(wanted, self.read("experiments"), "experiment"))
        run = registry.open_runs(wanted, run_name, token)
        self.append("runs", registry.missing_rows(run, self.read("runs"), "run_id"))
        return run.first()["run_id"]

    def add_models(self, models: DataFrame) -> None:
        self.append("models", models, ("run_id",))

    def add_trials(self, trials: DataFrame) -> None:
        self.append("trials", trials, ("run_id",))

    def add_stats(self, stats: DataFrame) -> None:
        """Result rows of a run, one per group."""
        self.append("stats", stats, ("run_id",))

    def models(self, run_id: str) -> DataFrame:
        return self.read("models").where(F.col("run_id") == run_id)

    def stats(self, run_id: str) -> DataFrame:
        return self.read("stats").where(F.col("run_id") == run_id)

    def _next_seq(self) -> int:
        last = self.read("versions").select("seq").unionByName(self.read("transitions").select("seq"))
        return (last.agg({"seq": "max"}).first()[0] or 0) + 1

    def register(self, name: str, run_id: str) -> int:
        """Create the name if missing and add a version that points at the run."""
        wanted = self.spark.createDataFrame([(name,)], TABLES["names"])
        self.append("names", registry.missing_rows(wanted, self.read("names"), "name"))
        request = self.spark.createDataFrame(
            [(self._next_seq(), name, run_id, f"runs/{run_id}/models")],
            "seq long, name string, run_id string, source string",
        )
        added = registry.next_versions(self.read("versions"), request, sizes=Sizes(1, 1, 1)).collect()  # one row
        self.append("versions", self.spark.createDataFrame([r.asDict() for r in added], TABLES["versions"]))
        return added[0]["version"]

    def add_column_model(self, name: str, expression: str) -> int:
        """Keep a scalar model, an SQL expression over ``x``, as the next version of its name."""
        if not name.isidentifier():
            raise ValueError(f"{name!r} cannot name a function")
        self.spark.range(1).select(F.lit(1.0).alias("x")).select(F.expr(expression).cast("double")).schema  # must resolve
        known = self.read("column_models").where(F.col("name") == name)
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        self.append("column_models", self.spark.createDataFrame([(name, version, expression)], TABLES["column_models"]))
        return version

    def column_model(self, name: str, version: int | None = None) -> Callable[[Column], Column]:
        """The model as a function of a column; the newest version if none is given.

        It becomes an SQL function of the session, ``name_v<version>``, which queries can call too.
        """
        known = self.read("column_models").where(F.col("name") == name)
        if version is not None:
            known = known.where(F.col("version") == version)
        found = known.orderBy(F.desc("version")).first()
        if found is None:
            raise LookupError(f"no column model {name!r}" + ("" if version is None else f" of version {version}"))
        function = f"{name}_v{found['version']}"
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(x DOUBLE) RETURNS DOUBLE RETURN {found['expression']}"
        )
        return lambda column: F.call_function(function, column.cast("double"))

    def transition(self, name: str, version: int, stage: str = registry.PRODUCTION) -> None:
        row = self.spark.createDataFrame([(self._next_seq(), name, version, stage)], TABLES["transitions"])
        self.append("transitions", row)

    def current(self) -> DataFrame:
        return registry.current_stages(self.read("versions"), self.read("transitions"))

    def production_models(self, name: str, stage: str = registry.PRODUCTION) -> DataFrame:
        _, run_id, _ = registry.resolve_one(self.current(), name, stage)
        return self.models(run_id)
