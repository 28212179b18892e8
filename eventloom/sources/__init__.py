from .catalog import CatalogError, check_catalog, load_catalog, read_catalog
from .identity import IDENTITY_SCHEMAS, ConcurrentUpdate, identity_buckets, merge_identity, read_identity, release_claim
from .ledger import (
    append_hashes, bootstrap_hashes, read_hash_ledger, read_hour_ledger, read_watermark,
    replace_hour_cells, write_watermark,
)
from .listing import list_files, list_hours, raw_directory
from .packets import (
    packet_fields, parse_packets, read_json_events, read_lines, read_listed, read_records,
)
from .runs import RunNameUsed, counting_rows, finished_runs

__all__ = [name for name in dir() if not name.startswith("_")]
