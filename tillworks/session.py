"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot product or customer may hold a third of all order lines: let AQE split its join partition,
    # even where that costs one more shuffle behind the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_roots: dict[str, str] = {}
#: By application and folder without scheme: whether the executors share it.
_shared: dict[tuple[str, str], bool] = {}
_working: ContextVar[list[str] | None] = ContextVar("working", default=None)


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one in local mode only.

    A path without scheme is resolved by the cluster's default file system; where that is a machine's own disk, the folder
    may still be mounted on all machines: it is tried, and refused if the executors' files do not get there. A ``file:``
    URI is taken at its word.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    alone = context.master == "local" or context.master.startswith("local[")
    if root:
        if not alone and ":" not in root and hadoop_fs(spark, root)[1].toUri().getScheme() == "file":
            if (tried := (context.applicationId, root)) not in _shared:
                _shared[tried] = path_exists(spark, root) and _executors_share(spark, root)
            if not _shared[tried]:
                raise ValueError("spark.checkpoint.dir has no scheme and would be a folder of each machine")
        return root.rstrip("/")
    if not alone:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tillworks-")
    return _local_roots[context.applicationId]


def _executors_share(spark: SparkSession, root: str) -> bool:
    """Whether rows that the executors write below a folder can all be read back: one row and file per core.

    Where each machine has a folder of its own, the driver does not find the files that it is to commit.
    """
    path = f"{root.rstrip('/')}/tillworks/probe-{uuid.uuid4().hex}"
    tasks = spark.sparkContext.defaultParallelism
    rows = spark.range(0, tasks, 1, tasks)
    fs, hadoop_path = hadoop_fs(spark, path)
    try:
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path).count() == tasks
    except PySparkException:
        return False
    finally:
        fs.delete(hadoop_path, True)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/tillworks/{label}-{uuid.uuid4().hex}"
    if (paths := _working.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written to the shared folder inside go when the block ends; frames that read them must not leave it."""
    paths: list[str] = []
    token = _working.set(paths)
    try:
        yield
    finally:
        _working.reset(token)
        for path in paths:
            fs, hadoop_path = hadoop_fs(spark, path)
            fs.delete(hadoop_path, True)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, qualified path) of a path, as Spark would resolve it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = hadoop_fs(spark, path)
    return fs.exists(hadoop_path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame computed once and read back from the shared folder.

    Its consumers share one computation, and it survives the loss of executors.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
