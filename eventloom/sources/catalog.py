"""The type catalog: text lines ``column:type``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import PARSED_TYPE


class CatalogError(ValueError):
    """A column an event needs is missing from the catalog or has an unknown type."""


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(column_name, column_type)``, both trimmed; blank lines are skipped."""
    parts = F.split("value", ":")
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(
            F.trim(parts[0]).alias("column_name"),
            F.trim(F.try_element_at(parts, F.lit(2))).alias("column_type"),
        )
    )


def load_catalog(
    spark: SparkSession, path: str, event_columns: Mapping[str, Sequence[str]]
) -> dict[str, str]:
    """The checked catalog entries of the columns the events need, on the driver.

    What reaches the driver is bounded by the configured columns, not by the file.
    """
    needed = sorted({c for cols in event_columns.values() for c in cols})
    rows = read_catalog(spark, path).where(F.col("column_name").isin(needed)).collect()
    types = {row.column_name: row.column_type for row in rows}
    check_catalog(types, event_columns)
    return types


def check_catalog(
    types: Mapping[str, str], event_columns: Mapping[str, Sequence[str]]
) -> None:
    """Fail before any job starts, naming every column that cannot be typed."""
    needed = [(e, c) for e, cols in event_columns.items() for c in cols]
    missing = sorted({f"{e}.{c}" for e, c in needed if c not in types})
    if missing:
        raise CatalogError(f"not in the type catalog: {', '.join(missing)}")
    unknown = sorted({f"{c}:{types[c]}" for _, c in needed if types[c] not in PARSED_TYPE})
    if unknown:
        raise CatalogError(f"unsupported type: {', '.join(unknown)}")
