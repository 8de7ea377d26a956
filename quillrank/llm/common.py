"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 2_000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder this package was imported from on the path of Python workers started from now on.

    On a cluster the package is installed on the executors or shipped with ``--py-files``, as always.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` for functions of this package, in batches of at most ``ROWS_AT_ONCE`` rows.

    Batches bound what an executor holds outside its heap and what a worker turns into Python objects; the
    session's setting is lowered to this, never raised.
    """
    session = df.sparkSession
    let_workers_import(session)
    now = int(session.conf.get(BATCH_CONF, "10000"))
    if not 0 < now <= ROWS_AT_ONCE:
        session.conf.set(BATCH_CONF, ROWS_AT_ONCE)
    return df.mapInArrow(run, schema)


def hash_limit(wanted: int, there: int) -> int:
    """The signed 64-bit hash up to which about ``wanted`` of ``there`` evenly spread hashes lie."""
    share = min(1.0, wanted / max(1, there))
    return min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))


_held: list = ["", None]


def held(name: str, make: Callable[[], object]):
    """What a Python worker keeps from one batch and task to the next: one thing at a time.

    A worker serves one operator after the other; what the last one kept goes before the next one's is made.
    """
    if _held[0] != name:
        _held[:] = ["", None]
        gc.collect()
        pa.default_memory_pool().release_unused()
        _held[:] = [name, make()]
    return _held[1]


def give_back(name: str = "") -> None:
    """Drop what is held under ``name`` and return free memory to the system, at the end of a task.

    Workers stay for the tasks of later operators, which need the room.
    """
    if name and _held[0] == name:
        _held[:] = ["", None]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)
