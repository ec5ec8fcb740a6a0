"""Session settings and the shared working area."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FEW_FILES = 8
_local_roots: dict[str, str] = {}
_shipped: set[str] = set()
_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def build_session(app_name: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def workspace(spark: SparkSession) -> str:
    """Root folder for intermediate tables and stream checkpoints.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="marquee-")
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the open scratch folder, or else the working area of this application."""
    folder = _scratch.get() or f"{workspace(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """Intermediate tables that are written inside go to a folder of their own, which is removed at the end.

    For work whose results are written elsewhere before the block ends; what is read lazily later must not
    depend on it.
    """
    folder = fresh_path(spark, name)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove(spark, folder)


def clear_workspace(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application."""
    remove(spark, f"{workspace(spark)}/{spark.sparkContext.applicationId}")


def _store(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it takes it; any store that Spark can reach."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def remove(spark: SparkSession, path: str) -> None:
    store, located = _store(spark, path)
    store.delete(located, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, located = _store(spark, path)
    return store.exists(located)


def children(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the folders ``key=value`` directly below a path, sorted; none if the path is not there."""
    store, located = _store(spark, path)
    if not store.exists(located):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(located)]
    return sorted(name[len(key) + 1:] for name in names if name.startswith(f"{key}="))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where several branches read the same result: the work is not repeated, the lineage is
    cut in storage that outlives an executor, and joins downstream see the real size.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is written inside go when it ends, and not when the driver collects garbage.

    For rounds of large shuffles, which else stay side by side.
    """
    with _turned_on(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"):
        yield


@contextlib.contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for queries that are written inside, where the session has it off."""
    with _turned_on(spark, "spark.sql.adaptive.enabled"):
        yield


@contextlib.contextmanager
def _turned_on(spark: SparkSession, name: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def spread(table: DataFrame) -> DataFrame:
    """Use all cores on a stored table of few files, as the small ones are; a table of many files is left alone.

    For tables as they are read: it asks for their files and plans nothing.
    """
    wanted = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(wanted) if len(table.inputFiles()) < min(wanted, FEW_FILES) else table


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Functions that run in tasks are pickled by name, so a worker started in another folder or on another
    machine has to be able to import them.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="marquee-package-")) / "marquee.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> None:
    """Settings that the jobs rely on, for a session that was built elsewhere.

    Times are UTC, and a join on (user, title) may use rows that are already placed by user instead of
    moving them again. The package is shipped to the workers.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
