"""What differs between games: event columns, id fields, lookup key, policy."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The attribute columns published per event type.  Their order is
# the order of the keys in ``event_value``.
HASHED_ID_EVENTS = {
    "transaction": (
        "purchase_count", "price", "session_id", "event_id", "platform_id", "country_code",
    ),
    "level_up": ("session_id", "level", "vip_level", "event_id", "platform_id"),
    "install": ("session_id", "event_id", "platform_id"),
    "start_session": (
        "version", "balance", "bingo_balls_balance", "platform_id",
        "blackdiamond_elite_active", "session_id", "event_id", "level", "vip_level",
        "device_type", "country_code",
    ),
    "worlds": ("session_id", "last_unlocked_world", "event_id", "platform_id"),
    "spin": ("bet_amount", "event_id", "session_id", "platform_id", "level", "slot_id"),
    "facebook_connect": ("session_id", "fb_id", "event_id"),
    "end_session": (
        "event_id", "session_id", "platform_id", "balance", "level", "vip_level",
        "country_code",
    ),
}

NUMERIC_ID_EVENTS = {
    "transaction": (
        "purchase_count", "price", "purchase_amount", "session_id", "event_id",
        "purchase_origin", "local_price", "real_exchange_rate", "platform_id",
        "country_code",
    ),
    "level_up": ("session_id", "level", "vip_level", "event_id"),
    "install": ("session_id", "event_id"),
    "start_session": (
        "version", "balance", "platform_id", "session_id", "event_id", "level",
        "vip_level", "spins_per_spinner", "country_code", "avg_bet", "total_bet",
        "device_type",
    ),
    "facebook_connect": ("session_id", "fb_id", "event_id"),
    "spin": ("bet_amount", "event_id", "session_id", "slot_id", "slot_location", "level"),
    "end_session": (
        "event_id", "session_id", "platform_id", "balance", "level", "vip_level",
        "last_activity_ts", "country_code",
    ),
}

PAIRED_ID_EVENTS = {
    "transaction": ("purchase_count", "price", "session_id", "event_id"),
    "level_up": ("session_id", "level", "vip_level", "event_id"),
    "install": ("session_id", "event_id"),
    "start_session": (
        "version", "balance", "bingo_balls_balance", "platform_id",
        "blackdiamond_elite_active", "session_id", "event_id",
    ),
    "worlds": ("session_id", "last_unlocked_world", "event_id"),
    "spin": ("bet_amount", "event_id", "session_id"),
    "facebook_connect": ("session_id", "facebook_id", "event_id"),
}


@dataclass(frozen=True)
class GameProfile:
    """One game's rules.

    ``id_fields`` maps the id keys added to ``event_value`` to the raw field each
    one copies.  ``lookup_field`` is the raw field the identity table is keyed by.
    ``required_ids`` says whether one of the raw id fields is enough ("any") or
    all of them must be present ("all").
    """

    game_id: str
    event_columns: Mapping[str, tuple[str, ...]]
    id_fields: Mapping[str, str] = field(
        default_factory=lambda: {
            "user_id_hashed": "user_id",
            "user_id_numeric": "numeric_user_id",
        }
    )
    lookup_field: str = "user_id"
    required_ids: str = "any"
    on_unresolved: str = "continue"

    def __post_init__(self) -> None:
        if self.required_ids not in ("any", "all"):
            raise ValueError(f"required_ids must be 'any' or 'all', not {self.required_ids!r}")
        if self.on_unresolved not in ("continue", "fail"):
            raise ValueError(
                f"on_unresolved must be 'continue' or 'fail', not {self.on_unresolved!r}"
            )
        if self.lookup_field not in ("user_id", "numeric_user_id"):
            raise ValueError(f"unknown lookup field {self.lookup_field!r}")

    @property
    def event_names(self) -> list[str]:
        return list(self.event_columns)

    @property
    def attribute_columns(self) -> list[str]:
        """Every attribute of every event type once, in first-seen order."""
        return list(dict.fromkeys(c for cols in self.event_columns.values() for c in cols))


def hashed_id_profile(game_id: str, **overrides) -> GameProfile:
    """Players known by a hashed id; the numeric id is carried along."""
    return GameProfile(game_id, **{"event_columns": HASHED_ID_EVENTS, **overrides})


def numeric_id_profile(game_id: str, **overrides) -> GameProfile:
    """Players known by a single numeric id."""
    settings = {
        "event_columns": NUMERIC_ID_EVENTS,
        "id_fields": {"user_id_numeric": "user_id"},
        **overrides,
    }
    return GameProfile(game_id, **settings)


def paired_id_profile(game_id: str, **overrides) -> GameProfile:
    """The earliest form: both ids required, lookup by the numeric one."""
    settings = {
        "event_columns": PAIRED_ID_EVENTS,
        "id_fields": {"user_id_hashed": "user_id", "user_id_ref": "numeric_user_id"},
        "lookup_field": "numeric_user_id",
        "required_ids": "all",
        **overrides,
    }
    return GameProfile(game_id, **settings)
