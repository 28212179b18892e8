"""Typed projection per event type and the envelope around it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import default_empty, trimmed
from ..functions.times import epoch_to_text, valid_millis
from ..functions.values import is_nested, typed_value, value_is_bad
from ..profiles import GameProfile
from ..sources.catalog import check_catalog
from .route import allow_events, reason_column

KEEP_NULLS = {"ignoreNullFields": "false"}


def _any(flags: list[Column]) -> Column:
    result = F.lit(False)
    for flag in flags:
        result = result | flag
    return result


def event_value(profile: GameProfile) -> Column:
    """The attributes of the row's event type as JSON, nulls kept, ids at the end.

    One branch per event type; only the matching one is evaluated.
    """
    ids = [default_empty(raw).alias(key) for key, raw in profile.id_fields.items()]
    tail = [F.col("ts").alias("epoch_time"), F.col("event_time"), *ids]
    value = F.lit(None).cast("string")
    for event, columns in profile.event_columns.items():
        attributes = [F.col(f"typed.`{c}`").alias(c) for c in columns]
        value = F.when(
            F.col("event_type") == event, F.to_json(F.struct(*attributes, *tail), KEEP_NULLS)
        ).otherwise(value)
    return value


def interpret(parsed: DataFrame, profile: GameProfile, types: Mapping[str, str]) -> DataFrame:
    """Parsed packets to typed rows that are ready for id resolution.

    Keeps the allowlisted events and the corrupt packets.  ``reason`` says why a
    row must not be published; only such rows keep their packet text.
    """
    check_catalog(types, profile.event_columns)
    columns = profile.attribute_columns
    attributes = [
        typed_value(
            F.col(f"`{c}`"), types[c], is_nested(F.col(f"`{c}`"), F.col("packet"), c)
            if types[c] in ("string", "boolean") else None,
        ).alias(c)
        for c in columns
    ]
    allowed = allow_events(parsed, profile.event_names, keep_corrupt=True)
    typed = allowed.withColumns(
        {
            "typed": F.struct(*attributes),
            "ts": valid_millis(typed_value(F.col("ts"), "long")),
        }
    ).withColumn("event_time", epoch_to_text("ts"))
    bad = _any(
        [
            (F.col("event_type") == event)
            & _any([value_is_bad(F.col(f"`{c}`"), F.col(f"typed.`{c}`")) for c in cols])
            for event, cols in profile.event_columns.items()
        ]
    )
    reasoned = typed.withColumn("reason", reason_column(profile, bad))
    kept = [c for c in ("date_hour",) if c in parsed.columns]
    return reasoned.select(
        *kept,
        F.col("event_type").alias("event_name"),
        "ts",
        trimmed(profile.lookup_field).alias("player_key"),
        default_empty("user_id").alias("user_id"),
        default_empty("numeric_user_id").alias("numeric_user_id"),
        "event_time",
        F.when(F.col("reason").isNull(), event_value(profile)).alias("event_value"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("packet")).alias("packet"),
    )


def splice(head: Column, key: str, value: Column) -> Column:
    """Add ``"key": value`` to a JSON object whose last value is a string, as text.

    The event value is rendered once and reused here, not rendered a second time
    as part of the envelope.  The closing quote before the brace stops the trim
    after that one brace.
    """
    return F.concat(F.rtrim(head, F.lit("}")), F.lit(f',"{key}":'), value, F.lit("}"))


def envelope_json(game_id: Column | str, user_id: str = "goc_id") -> Column:
    """The published form of a row."""
    game = F.lit(game_id) if isinstance(game_id, str) else game_id
    head = F.struct(
        game.alias("game_id"),
        F.col("event_time"),
        F.col("event_name"),
        F.col(user_id).alias("user_id"),
    )
    return splice(F.to_json(head, KEEP_NULLS), "event_value", F.col("event_value"))
