"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "leadpipe", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="leadpipe-"))
        named = context.getCheckpointDir()
    return named


# Paths handed out within the innermost open `scratch_scope`.
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _SCOPES.get()[-1:]:
        paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete all scratch tables made within the block at its end; what reads them must have run by then."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            remove(spark, path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new path below the shared folder that is deleted at the end of the block.

    What reads it must have run by then.
    """
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)
