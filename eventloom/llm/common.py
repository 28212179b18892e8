"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..session import discard, scratch_path

__all__ = ["discard", "documents", "drop_table", "keep_table", "scratch_path", "ship"]

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keep_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor later costs a read, not the work before.
    The table stays until ``drop_table`` or until the folder is cleaned, since results are
    read lazily.  The shuffle files behind it go at once, not when the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def drop_table(kept: DataFrame) -> None:
    """Delete a table of ``keep_table`` that nothing reads any more."""
    discard(kept.sparkSession, kept.kept_at)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Nothing to do where the package is on PYTHONPATH or installed; else Spark's
    file server hands out an archive of it.
    """
    root = os.path.dirname(_PACKAGE)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    if getattr(spark.sparkContext, "_eventloom_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="eventloom-code-"), "eventloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._eventloom_shipped = True
