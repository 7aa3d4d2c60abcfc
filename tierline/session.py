"""Session helpers: settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SPACE: ContextVar[str | None] = ContextVar("scratch space", default=None)


def build_session(app: str = "tierline", master: str | None = None, **conf: object) -> SparkSession:
    """Session with UTC time and adaptive execution; keyword settings use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Feed timestamps with a zone become UTC wall time only in a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path for intermediate tables, in a folder that driver and executors share.

    That is ``spark.checkpoint.dir``, or a folder below the warehouse if the session does not set it. Within a
    ``scratch_space`` it lies there.
    """
    base = _SPACE.get() or spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_space(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for all intermediate tables of a block of code, removed at its end."""
    path = scratch_dir(spark, label)
    token = _SPACE.set(path)
    try:
        yield path
    finally:
        _SPACE.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
