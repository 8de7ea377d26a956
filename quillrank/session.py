"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(app_name: str = "quillrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on.

    Parquet reads skip row groups by lists of up to 50 tokens.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.pushdown.inFilterThreshold": "50",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where it lies.

    On a cluster the package is installed on the executors or shipped with ``--py-files``, as always.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def work_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and working tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors share one disk, falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="quillrank-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder, in a folder of this application's own."""
    application = spark.sparkContext.applicationId
    path = f"{work_folder(spark).rstrip('/')}/quillrank/{application}/{name}-{uuid.uuid4().hex}"
    for made in getattr(_scopes, "open", []):
        made.append(path)
    return path


_scopes = threading.local()


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove the working tables that this thread makes inside, once the block is done.

    What is read from them must be written elsewhere before the block ends.
    """
    made: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", []), made]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        remove_paths(spark, made)


@contextmanager
def by_bucket(spark: SparkSession) -> Iterator[None]:
    """Scans of bucketed tables inside read one bucket a task, whether a later step asks for that or not."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that this library wrote, on any file system Spark reaches."""
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(configuration).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a working table and read it back, cutting the lineage."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` cut from its lineage in the shared folder, in the same tasks and order, and the path it lies under."""
    work_folder(df.sparkSession)
    stored = df.checkpoint()
    return stored, stored._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
