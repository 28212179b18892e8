"""The given tables in the shapes the engine reads, and the same shapes in SQL.

* ``events`` are the telemetry: players "p<user_id>", attributes ``value`` and ``k``.
* ``customer`` is the identity table; customers of one market segment are not
  registered, so lookups miss.
* Every event also stands for a file written at its time, for listings and ledgers.
* ``error`` events become the four kinds of packets that cannot be published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import hashed_id_profile, prepare, scratch_path
from eventloom.functions.text import PACKET_SEPARATOR_TEXT
from eventloom.functions.times import HOUR_PATH, epoch_millis
from eventloom.sinks.publish import hour_columns

GAME = "check game"
PROFILE = hashed_id_profile(
    GAME,
    event_columns={
        "click": ("k", "event_id"),
        "view": ("value", "event_id"),
        "purchase": ("value", "k", "event_id"),
    },
)
TYPES = {"k": "long", "value": "double", "event_id": "long"}

UNREGISTERED = "MACHINERY"
CUT_OFF = "2024/01/15/12"
BEFORE_CUT_OFF = "2024/01/15/11"
NOW_HOUR = "2024/01/20/21"
NOW = "2024-01-20 21:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the raw fields of its packet."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_type",
        epoch_millis(events, "ts").alias("ts"),
        F.concat(F.lit("p"), F.col("user_id")).alias("user_id"),
        F.col("user_id").cast("string").alias("numeric_user_id"),
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.date_format("ts", HOUR_PATH).alias("date_hour"),
    )


FIELDS = ("event_type", "ts", "user_id", "numeric_user_id", "event_id", "value", "k")


def packet_text(events: DataFrame) -> DataFrame:
    """``(value, date_hour)``: one packet per line."""
    return events.select(F.to_json(F.struct(*FIELDS)).alias("value"), "date_hour")


# Milliseconds far beyond the last timestamp.
NO_TIME = 99_999_999_999_999_999


def spoiled(events: DataFrame) -> DataFrame:
    """Packets where the error events are broken in one of six ways, by ``k``."""
    good = F.to_json(F.struct(*FIELDS))
    error = F.col("event_type") == "error"
    as_click = F.struct(F.lit("click").alias("event_type"), *FIELDS[1:])
    value = (
        F.when(~error, good)
        .when(F.col("k") < 25, F.concat(F.lit("{error "), F.col("event_id"), F.lit("}")))
        .when(F.col("k") < 38, F.to_json(as_click.dropFields("ts")))
        .when(F.col("k") < 50, F.to_json(as_click.withField("ts", F.lit(NO_TIME))))
        .when(F.col("k") < 75, F.to_json(as_click.withField("user_id", F.lit(" "))))
        .when(F.col("k") < 88, F.to_json(as_click.withField("k", F.lit("many"))))
        .otherwise(F.to_json(as_click.withField("k", F.struct(F.lit(1).alias("n")))))
    )
    return events.select(value.alias("value"), "date_hour")


def framed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several packets of one hour per line.

    Lines are made per run of eight consecutive event ids, so their size is bounded.
    """
    events = raw_events(spark, sf_dir)
    packets = events.select(
        F.to_json(F.struct(*FIELDS)).alias("packet"),
        "date_hour",
        F.floor(F.col("event_id") / 8).alias("line"),
    )
    lines = packets.groupBy("date_hour", "line").agg(F.collect_list("packet").alias("packets"))
    text = F.concat(F.lit("head "), F.concat_ws(PACKET_SEPARATOR_TEXT, "packets"), F.lit(" tail"))
    return lines.select(text.alias("value"), "date_hour")


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != UNREGISTERED)
    return customers.select(
        F.concat(F.lit(" p"), F.col("c_custkey")).alias("player_id"),
        F.col("c_name").alias("goc_id"),
        F.col("c_custkey").cast("string").alias("numeric_id"),
        F.lit(1).cast("bigint").alias("seq"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a file in its hour's directory, modified at the event's time."""
    events = table(spark, sf_dir, "events")
    hour = F.date_format("ts", HOUR_PATH)
    tail = F.concat(F.lit("/raw/prod/"), hour, F.lit("/part-"), F.col("event_id"))
    return events.select(
        F.concat(F.lit("hdfs://cluster:8020"), tail).alias("path"),
        tail.alias("clean_path"),
        hour.alias("date_hour"),
        F.col("ts").cast("timestamp").alias("modification_time"),
        F.length("props").cast("bigint").alias("length"),
        "event_id",
    )


_RAW_ROOTS: dict[tuple[str, str], str] = {}


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The root of the framed events as text files under ``date=/hour=``.

    Written once per application and table directory; queries only read them.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _RAW_ROOTS:
        return _RAW_ROOTS[known]
    root = scratch_path(prepare(spark), "raw")
    lines = hour_columns(framed_events(spark, sf_dir)).select("date", "hour", "value")
    lines.hint("rebalance", "date", "hour").write.partitionBy("date", "hour").text(root)
    _RAW_ROOTS[known] = root
    return root


# -- the same shapes in SQL --------------------------------------------------------

RAW_SQL = """
raw AS (
  SELECT event_id, event_type, ts, value, user_id,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         epoch_us(ts) // 1000 AS ms,
         'p' || user_id AS uid,
         strftime(ts, '%Y/%m/%d/%H') AS date_hour,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
         '/raw/prod/' || strftime(ts, '%Y/%m/%d/%H') || '/part-' || event_id AS clean_path
  FROM events)"""

PACKET_SQL = """
packets AS (
  SELECT *, '{"event_type":"' || event_type || '","ts":' || ms || ',"user_id":"' || uid
            || '","numeric_user_id":"' || user_id || '","event_id":' || event_id
            || ',"value":' || value || ',"k":' || k || '}' AS packet
  FROM raw)"""

VALUE_SQL = """
typed AS (
  SELECT *, '{' || CASE event_type
                     WHEN 'click' THEN '"k":' || k
                     WHEN 'view' THEN '"value":' || value
                     ELSE '"value":' || value || ',"k":' || k END
            || ',"event_id":' || event_id || ',"epoch_time":' || ms
            || ',"event_time":"' || event_time || '","user_id_hashed":"' || uid
            || '","user_id_numeric":"' || user_id || '"}' AS event_value
  FROM raw WHERE event_type IN ('click', 'view', 'purchase'))"""

RESOLVED_SQL = f"""
resolved AS (
  SELECT typed.*, coalesce(c_name, '') AS goc_id
  FROM typed LEFT JOIN customer
    ON c_custkey = user_id AND c_mktsegment <> '{UNREGISTERED}')"""

# The same once the new players that events name have ids.
REGISTERED_SQL = RESOLVED_SQL.replace(
    "coalesce(c_name, '')",
    f"CASE WHEN c_mktsegment = '{UNREGISTERED}' THEN 'new ' ELSE '' END || coalesce(c_name, '')",
).replace(f" AND c_mktsegment <> '{UNREGISTERED}'", "").replace(
    f"c_mktsegment = '{UNREGISTERED}' THEN", f"coalesce(c_mktsegment, '') = '{UNREGISTERED}' THEN"
)

ENVELOPE_SQL = f"""
enveloped AS (
  SELECT *, '{{"game_id":"{GAME}","event_time":"' || event_time || '","event_name":"'
            || event_type || '","user_id":"' || goc_id || '","event_value":'
            || event_value || '}}' AS envelope
  FROM resolved)"""

SPOILED_SQL = """
spoiled AS (
  SELECT event_id, date_hour, ms,
         CASE WHEN k < 25 THEN 'corrupt' WHEN k < 50 THEN 'missing_key'
              WHEN k < 75 THEN 'no_user_id' ELSE 'bad_value' END AS reason,
         CASE WHEN k < 25 THEN '{error ' || event_id || '}'
              ELSE '{"event_type":"click"' || CASE WHEN k < 38 THEN ''
                WHEN k < 50 THEN ',"ts":99999999999999999' ELSE ',"ts":' || ms END
                || ',"user_id":"' || CASE WHEN k BETWEEN 50 AND 74 THEN ' ' ELSE uid END
                || '","numeric_user_id":"' || user_id || '","event_id":' || event_id
                || ',"value":' || value
                || ',"k":' || CASE WHEN k < 75 THEN CAST(k AS VARCHAR)
                  WHEN k < 88 THEN '"many"' ELSE '{"n":1}' END
                || '}' END AS packet
  FROM raw WHERE event_type = 'error')"""


def with_parts(body: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body
