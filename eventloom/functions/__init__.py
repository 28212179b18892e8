from .paths import (
    clean_path, date_hour_after_prod, date_hour_of_path, day_of, file_hash, hour_of,
    path_after, path_tail,
)
from .text import brace_slice, default_empty, event_type_of, packets_of, row_json, trimmed
from .times import (
    COMPACT_DAY, DAY, DAY_PATH, FILE_STAMP, HOUR_PATH, MINUTE, RUN_STAMP, SECOND,
    day_sequence, epoch_millis, epoch_to_text, epoch_to_pacific, format_time,
    hour_sequence, in_zone, valid_millis,
)
from .values import is_nested, typed_value, value_is_bad

__all__ = [name for name in dir() if not name.startswith("_")]
