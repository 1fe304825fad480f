"""Lifetime of intermediate tables.

Jobs write what they read several times into the shared ``spark.checkpoint.dir``.  Whoever runs a job owns these
tables: inside ``with Intermediates():`` every table that is written belongs to the block and is deleted when it
ends, also by an exception.  A DataFrame that reads such a table must be used (written, collected) inside the block.
Tables written outside any block live as long as the process and are deleted when it ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from contextvars import ContextVar

from pyspark.sql import SparkSession

from ferrule.session import ensure_checkpoint_dir

__all__ = ["Intermediates", "table_path", "delete", "exists"]

_current: ContextVar[Intermediates | None] = ContextVar("ferrule_intermediates", default=None)
_process: list[tuple] = []           # (path, file system) of tables that no block owns


def _file_system(spark: SparkSession, path: str):
    """(path, its file system) as the cluster sees them; works for any store that Spark can write."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


class Intermediates:
    """``with Intermediates() as own:`` deletes the tables written inside it; blocks may be nested."""

    def __init__(self):
        self._owned: list[tuple] = []
        self._token = None

    def __enter__(self) -> Intermediates:
        self._token = _current.set(self)
        return self

    def add(self, spark: SparkSession, path: str) -> None:
        self._owned.append(_file_system(spark, path))

    def __exit__(self, *exc) -> None:
        _current.reset(self._token)
        _drop(self._owned)


def _drop(owned: list[tuple]) -> None:
    while owned:
        p, fs = owned.pop()
        with contextlib.suppress(Exception):       # the store may be gone already; what is left is only disk
            fs.delete(p, True)


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under the shared checkpoint folder, owned by the current block."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ferrule-{name}-{uuid.uuid4().hex[:16]}"
    block = _current.get()
    if block is not None:
        block.add(spark, path)
    else:
        if not _process:
            atexit.register(_drop, _process)
        _process.append(_file_system(spark, path))
    return path
