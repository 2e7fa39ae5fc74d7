"""Shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="pagequill-")


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, Spark must run on this machine only, and a new folder here is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder(spark.sparkContext.applicationId)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get():
        scope.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are written to the scratch folder inside go when it is left.

    What is returned from inside must be written elsewhere before.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            remove_folder(spark, path)
