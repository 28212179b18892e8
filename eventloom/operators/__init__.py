from .backlog import (
    LagAlert, append_listings, flag_unread, group_paths, hours_after, newest_hours, next_day_hours, not_read, pending_hours,
    settled, unread_by_hour, unseen,
)
from .counts import (
    alert_rows, any_per_event_type, first_per_event_type, hour_counts, observe_routes,
    registration_hits, top_rows,
)
from .identity import (
    distinct_players, forward_entries, latest_per_key, numeric_entries, resolve_by_distinct_keys, resolve_ids,
    reverse_entries, unresolved_keys, upsert,
)
from .project import envelope_json, event_value, interpret, splice
from .route import allow_events, allow_users, early_allowlist, reason_column, route

__all__ = [name for name in dir() if not name.startswith("_")]
