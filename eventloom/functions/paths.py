"""Expressions over file paths of the form ``<root>/yyyy/MM/dd/HH/file``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_hash(path: Column | str) -> Column:
    """Lower-case hex MD5 of the path, the key of the file ledger."""
    return F.md5(_col(path))


def date_hour_after_prod(path: Column | str) -> Column:
    """The ``yyyy/MM/dd/HH`` part behind ``/prod/``, or an empty string."""
    # anchored, so that a path without a match is scanned once and not from each place
    return F.regexp_extract(_col(path), r"^.*/prod/(\d{4}/\d{2}/\d{2}/\d{2})", 1)


def date_hour_of_path(path: Column | str) -> Column:
    """``yyyy/MM/dd/HH`` of a file's own directory, or an empty string.

    Reads both the plain layout ``2024/01/05/13/`` and the partitioned one
    ``date=2024-01-05/hour=13/``.
    """
    part = F.regexp_extract(
        _col(path), r"/(?:date=)?(\d{4}[/-]\d{2}[/-]\d{2}/(?:hour=)?\d{2})/[^/]*$", 1
    )
    return F.translate(F.replace(part, F.lit("hour="), F.lit("")), "-", "/")


def path_tail(path: Column | str, length: int = 13) -> Column:
    """The last ``length`` characters: the date-hour of an hour directory."""
    return F.right(_col(path), F.lit(length))


def day_of(date_hour: Column | str) -> Column:
    return F.left(_col(date_hour), F.lit(10))


def hour_of(date_hour: Column | str) -> Column:
    return F.right(_col(date_hour), F.lit(2))


def path_after(path: Column | str, marker: str = "prod/", length: int | None = None) -> Column:
    """Text behind the first ``marker``, cut to ``length`` characters if given."""
    rest = F.element_at(F.split(_col(path), marker), 2)
    return rest if length is None else F.left(rest, F.lit(length))


def clean_path(path: Column | str) -> Column:
    """The path without its scheme and host."""
    return F.regexp_replace(_col(path), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
