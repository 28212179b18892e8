from .ingest import (
    LINES, RECORDS, Framing, Layout, Sink, UnresolvedIds, backfill_run, finish_run, hash_ledger_run,
    hour_ledger_run, parked_rows, published_rows, register, replay, seed_hash_ledger, text_sink, transform,
    watermark_run,
)
from .merge import merge_small_files, published_files

__all__ = [name for name in dir() if not name.startswith("_")]
