from .publish import (
    copy_text, drop_hours_of_runs, drop_other_runs, hour_columns, publish_topic, write_by_hour, write_by_run, write_rows,
)

__all__ = [name for name in dir() if not name.startswith("_")]
