"""Telemetry ingest on Spark: raw packet files to published event envelopes."""

from .profiles import GameProfile, hashed_id_profile, numeric_id_profile, paired_id_profile
from .session import prepare, scratch_path

__all__ = [
    "GameProfile", "hashed_id_profile", "numeric_id_profile", "paired_id_profile",
    "prepare", "scratch_path",
]
