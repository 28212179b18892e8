"""Which rows go on, and where the others go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import brace_slice, event_type_of, trimmed
from ..profiles import GameProfile

PUBLISHED = "published"
UNRESOLVED = "unresolved"
QUARANTINE = "quarantine"

CORRUPT = "corrupt"
MISSING_KEY = "missing_key"
NO_USER_ID = "no_user_id"
BAD_VALUE = "bad_value"


def allow_events(events: DataFrame, names: Sequence[str], keep_corrupt: bool = False) -> DataFrame:
    """Rows of the named event types, case-sensitive; a missing type drops the row.

    Packets that are not JSON have no type.  ``keep_corrupt`` lets them through so
    that they can be routed aside instead of vanishing.
    """
    wanted = F.col("event_type").isin(list(names))
    if keep_corrupt:
        wanted = wanted | F.col("corrupt").isNotNull()
    return events.where(wanted)


def early_allowlist(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same allowlist on unparsed text, adding ``event_type``.

    Cheaper where most packets are unwanted; text that is not JSON is dropped.
    """
    packet = brace_slice("value")
    return records.withColumn("event_type", event_type_of(packet)).where(
        F.col("event_type").isin(list(names))
    )


def allow_users(
    events: DataFrame, users: DataFrame, key: str = "user_id", listed: str | None = None
) -> DataFrame:
    """Rows of the users in a list, for corrections.

    ``key`` is the field of the events, ``listed`` the column of the list where it has
    another name.  Both are trimmed, as in a lookup; a blank key matches nobody.
    """
    wanted = users.select(trimmed(listed or key).alias("listed_user")).where("listed_user <> ''")
    return events.join(wanted, trimmed(f"`{key}`") == F.col("listed_user"), "left_semi")


def reason_column(profile: GameProfile, bad_value: Column) -> Column:
    """Why a parsed row cannot be published; null where it can.

    ``ts`` is already a number here.  An id field counts as present when it is in
    the packet with any value, an empty one included.
    """
    ids = list(dict.fromkeys(profile.id_fields.values()))
    if profile.required_ids == "all":
        no_ids = F.greatest(*[F.col(i).isNull() for i in ids]) if len(ids) > 1 else F.col(ids[0]).isNull()
    else:
        no_ids = F.col("user_id").isNull() & F.col("numeric_user_id").isNull()
    return (
        F.when(F.col("corrupt").isNotNull(), CORRUPT)
        .when(F.col("ts").isNull() | no_ids, MISSING_KEY)
        .when(F.trim(F.coalesce(profile.lookup_field, F.lit(""))) == "", NO_USER_ID)
        .when(bad_value, BAD_VALUE)
    )


def route(resolved: DataFrame) -> DataFrame:
    """Add ``route``: quarantine with a reason, else by whether an id was found."""
    return resolved.withColumn(
        "route",
        F.when(F.col("reason").isNotNull(), QUARANTINE)
        .when(F.col("goc_id") == "", UNRESOLVED)
        .otherwise(PUBLISHED),
    )
