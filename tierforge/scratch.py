"""Where intermediate tables go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tierforge.storage import Folder

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that is not set, a session within one process uses a folder of its warehouse; on a
    cluster, whose executors might not see that, it is an error.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` out and read it back.

    Used where one result feeds several branches: they then share one evaluation, losing
    an executor costs no more than rereading files, and the planner knows the true size
    when it chooses whether to broadcast. What was shuffled to make it is of no more use and
    deleted at once; otherwise it stays until the driver happens to collect its garbage.
    """
    path = scratch_dir(df.sparkSession, label)
    with _setting(df.sparkSession, _CLEANUP, "true"):
        df.write.parquet(path)
    if (staged := _STAGED.get()) is not None:
        staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged within the block once it ends, when its result has been stored."""
    token = _STAGED.set([])
    try:
        yield
    finally:
        for path in _STAGED.get() or ():
            Folder(spark, path).delete_all()
        _STAGED.reset(token)
