"""Session settings shared by jobs, tests and checks."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings every plan in this package expects.  AQE sizes the reduce
# side from real shuffle statistics and splits hot join partitions, so no plan
# here carries a hand-picked partition count.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles keep all cores busy: writing many hour directories from one
    # task costs far more than scheduling a few tasks.  Large ones are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task with rows for few directories keeps one file open for each instead of
    # sorting all its rows by directory first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


_SCOPE: ContextVar[str | None] = ContextVar("eventloom_scratch_scope", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the UTC zone and the adaptive settings on a running session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder.  Only where it is unset and all
    runs in this one process does a local temporary folder stand in for it.
    """
    if _SCOPE.get() is not None:
        return f"{_SCOPE.get()}/{label}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventloom-")
    return f"{base.rstrip('/')}/eventloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that ``scratch_path`` names inside are dropped together at the end."""
    folder = scratch_path(spark, "scope")
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        discard(spark, folder)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named, once nothing reads it any more."""
    if "/eventloom/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
