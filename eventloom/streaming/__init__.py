from .incremental import run_incremental, stream_lines
from .listener import QueryAlerts, watch
from .stateful import STATE_STORE, stream_hour_counts, stream_topic, stream_worklist

__all__ = [name for name in dir() if not name.startswith("_")]
