"""Where jobs put the tables they write between stages.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``, so a
lost executor never takes an intermediate result with it.  A folder of our own
is used only where the session names none and runs in local mode (tests).
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stratafold-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, or under the run's part of it, that nothing has used yet."""
    scope = _scope.get()
    root = shared_root(spark)
    if scope is not None:
        scope[1].append(spark)
        root = f"{root}/{scope[0]}"
    return f"{root}/{label}-{uuid.uuid4().hex}"


# The name of the running plan's folder, and the sessions that used it.
_scope: ContextVar[tuple[str, list[SparkSession]] | None] = ContextVar("scope", default=None)


def cleans_up(plan: Callable) -> Callable:
    """A plan whose intermediate tables go when it ends, also when it fails.

    What it returns must not read them.  Inside another such plan the outer one cleans up.
    """

    @functools.wraps(plan)
    def run(*args, **options):
        if _scope.get() is not None:
            return plan(*args, **options)
        name, sessions = scope = (f"run-{uuid.uuid4().hex}", [])
        token = _scope.set(scope)
        try:
            return plan(*args, **options)
        finally:
            _scope.reset(token)
            if sessions:
                delete_folder(sessions[0], f"{shared_root(sessions[0])}/{name}")

    return run


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with the file system its path belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str, observe: Observation | None = None, metrics: Sequence[Column] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same result: unlike a cached copy it
    survives lost executors, and later reads still prune columns.  ``metrics``
    are computed while writing and found in ``observe`` afterwards.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    rows = df if observe is None else df.observe(observe, *metrics)
    rows.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
