"""Raw files to parsed packets.

A parsed frame has one row per packet: ``date_hour``, ``packet`` (the text),
the raw fields of ``packet_fields`` and ``corrupt`` (the text where it is not
JSON).  The schema is declared, so no pass over the data infers it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import date_hour_of_path, day_of, hour_of
from ..functions.text import PACKET_SEPARATOR, RECORD_SEPARATOR, packets_of
from ..functions.values import PARSED_TYPE
from ..profiles import GameProfile
from .listing import raw_directory

# The fields every packet may carry besides its attributes.
ENVELOPE_FIELDS = ("event_type", "ts", "user_id", "numeric_user_id")


def packet_fields(profile: GameProfile, types: Mapping[str, str]) -> dict[str, str]:
    """Raw field -> parsed type, for the fields this profile reads."""
    fields = dict.fromkeys(ENVELOPE_FIELDS, "string")
    for column in profile.attribute_columns:
        fields.setdefault(column, PARSED_TYPE[types[column]])
    return fields


def _ddl(fields: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """``(value, date_hour)`` for each text line of directories, globs or files.

    Plain text is split between tasks as it is.  ``partitions`` deals the lines out
    anew, for files that one task must read whole, as compressed ones.
    """
    return _read_text(spark.read, paths, partitions)


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    separator: str = RECORD_SEPARATOR,
    partitions: int | None = None,
) -> DataFrame:
    """Like ``read_lines`` with a record separator, so newlines are ordinary data."""
    return _read_text(spark.read.option("lineSep", separator), paths, partitions)


def _read_text(reader, paths: str | Sequence[str], partitions: int | None) -> DataFrame:
    # Hour directories may be hive-style; the hour comes from the path in both
    # layouts, so partition discovery is switched off.
    text = reader.option("recursiveFileLookup", "true").text(paths)
    lines = text.select("value", date_hour_of_path("_metadata.file_path").alias("date_hour"))
    return lines if partitions is None else lines.repartition(partitions)


def read_listed(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    hours: Sequence[str],
    partitioned: bool = False,
    separator: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``(value, date_hour)`` of the listed files: a semi-join, so no path leaves Spark.

    ``files`` has ``path`` and ``date_hour``, as a listing has them, for ``hours`` alone, and
    goes to every task: keep it to a slice of a backlog.  Only the directories of ``hours``
    are scanned; below a partitioned root the slice prunes them again as the job runs.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    folders = [f"{root.rstrip('/')}/{raw_directory(hour, partitioned)}" for hour in hours]
    if not folders:
        return spark.createDataFrame([], "value string, date_hour string")
    # Spark escapes the paths of read files, but not those of listed ones; a plus is itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    if partitioned:
        text = reader.option("basePath", root).schema("value string, date string, hour string").text(folders)
        text = text.withColumn("path", path)
        parts = {
            "date": F.translate(day_of("date_hour"), "/", "-"),
            "hour": hour_of("date_hour"),
        }
        chosen = files.select("path", *[c.alias(name) for name, c in parts.items()])
        keys = ["date", "hour", "path"]
    else:
        text = reader.option("recursiveFileLookup", "true").text(folders).withColumn("path", path)
        chosen, keys = files.select("path"), ["path"]
    lines = text.join(F.broadcast(chosen), keys, "left_semi").select(
        "value", date_hour_of_path("path").alias("date_hour")
    )
    return lines if partitions is None else lines.repartition(partitions)


def parse_packets(
    lines: DataFrame,
    fields: Mapping[str, str],
    separator: str | None = PACKET_SEPARATOR,
) -> DataFrame:
    """Unframe ``lines.value`` and parse each packet once.

    Without a ``separator`` each value is one packet.

    Parsing sits inside the generator on purpose.  Were it a plain projection,
    Catalyst would copy ``from_json`` into every filter pushed below it and each
    packet would be parsed twice.
    """
    return _parsed(lines, fields, packets_of("value", separator))


def _parsed(lines: DataFrame, fields: Mapping[str, str], packets: Column) -> DataFrame:
    schema = _ddl({**fields, "corrupt": "string"})
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}

    def parsed(packet):
        return F.struct(
            packet.alias("packet"), F.from_json(packet, schema, options).alias("fields")
        )

    kept = [c for c in lines.columns if c != "value"]
    return lines.select(*kept, F.inline(F.transform(packets, parsed))).select(
        *kept, "packet", "fields.*"
    )


def read_json_events(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Newline-delimited JSON, one event per line.

    With ``fields`` the frame is shaped like ``parse_packets``.  Without them the
    schema is inferred, which costs a pass over the data.
    """
    if fields is not None:
        # as text, so that a packet set aside keeps the fields that were not declared
        return _parsed(read_lines(spark, paths), fields, F.array_remove(F.array("value"), ""))
    reader = spark.read.option("recursiveFileLookup", "true")
    hour = date_hour_of_path("_metadata.file_path").alias("date_hour")
    return reader.json(paths).select("*", hour)
