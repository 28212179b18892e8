"""Expressions over raw packet text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two ways packets are framed in a file.
PACKET_SEPARATOR = r"\*##\*"
PACKET_SEPARATOR_TEXT = "*##*"
RECORD_SEPARATOR = "**##**"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def brace_slice(text: Column | str) -> Column:
    """From the first ``{`` to the last ``}``; an empty string without braces."""
    return F.regexp_extract(_col(text), r"(?s)\{.*\}", 0)


def packets_of(line: Column | str, separator: str | None = PACKET_SEPARATOR) -> Column:
    """The non-empty packets of one line, or the line as one packet, as an array."""
    if separator is None:
        sliced = F.array(brace_slice(line))
    else:
        sliced = F.transform(F.split(_col(line), separator), brace_slice)
    return F.filter(sliced, lambda packet: packet != "")


def event_type_of(packet: Column | str) -> Column:
    return F.get_json_object(_col(packet), "$.event_type")


def default_empty(text: Column | str) -> Column:
    """The text, or an empty one where it is null."""
    return F.coalesce(_col(text), F.lit(""))


def row_json(*columns: Column | str) -> Column:
    """The columns as a JSON object; null fields do not appear."""
    return F.to_json(F.struct(*columns))


def trimmed(key: Column | str) -> Column:
    """A lookup key: null becomes empty and outer spaces go."""
    return F.trim(default_empty(key))
