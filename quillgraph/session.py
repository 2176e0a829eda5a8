"""Session settings, shared scratch tables and partition helpers."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "quillgraph", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables handed from one job to the next.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session that names none gets a
    folder of its own, removed when the driver ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        path = tempfile.mkdtemp(prefix="quillgraph-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _LOCAL_DIRS[context.applicationId] = path
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"


class ScratchScope:
    """The scratch tables written while it is open; they are deleted when it ends.

    Tables are lazy to read, so a result that reads some of them has to be written before: to a place of one's own, or by
    :meth:`keep`, which hands its table on to the scope around this one.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> ScratchScope:
        _SCOPES.append(self)
        return self

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """``df`` as a written table that outlives this scope."""
        at = _SCOPES.index(self)
        inner = _SCOPES[at:]
        del _SCOPES[at:]
        try:
            return materialize(df, tag)
        finally:
            _SCOPES.extend(inner)

    def __exit__(self, *_: object) -> None:
        _SCOPES.remove(self)
        for path in self.paths:
            delete_path(self.spark, path)


#: The open scopes, the innermost last.
_SCOPES: list[ScratchScope] = []


def result_only(tag: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For functions that write scratch tables: their result is written, and of all their tables it alone remains."""

    def around(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(function)
        def run(first: DataFrame | SparkSession, *args: object, **options: object) -> DataFrame:
            spark = first if isinstance(first, SparkSession) else first.sparkSession
            with ScratchScope(spark) as scope:
                return scope.keep(function(first, *args, **options), tag)

        return run

    return around


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it lies; one that is not there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the optimizer the true size of the table,
    so that it can choose broadcast joins by itself. The files are compressed harder than tables that are kept.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_measured(df: DataFrame, tag: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Like :func:`materialize`, and also return aggregates of the written rows."""
    table = materialize(df, tag)
    return table, table.agg(*[expr.alias(name) for name, expr in metrics.items()]).first().asDict()


def broadcast_limit(spark: SparkSession) -> int:
    """The size in bytes up to which the session lets Spark broadcast a side of a join; 0 if it is switched off."""
    size = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return max(0, int(size))


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all task slots, if the table is smaller than one full file split for each of them.

    A small file, or one with few row groups, is read by few tasks; what follows would leave the other slots idle. A
    larger table stays as its splits are, without a shuffle.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(slots) if size < slots * split else df


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """So many tasks that none has more than ``each`` of ``rows`` rows, if they are dealt evenly; one for each slot at least.

    What a task holds then does not grow with the table, as it does where Spark merges the partitions of a shuffle or has a fixed
    number of them.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def drop_materialized(df: DataFrame) -> None:
    """Delete the files behind a table of :func:`materialize` that no later plan reads."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        delete_path(df.sparkSession, folder)
