"""Readers and writers of the device log and its reference tables."""

from playlens.sources.logs import LOG_COLUMNS, clean, events, preview, read_device_log, read_mixed_device_log
from playlens.sources.maps import (
    CONTENT_SCHEMA, PROFILE_SCHEMA, read_content_map, read_content_map_parquet, read_checked_csv, read_profile,
    read_usage_input, readable, rows_to_frame, with_length_seconds,
)
from playlens.sources.sinks import register_views, write_bucketed, write_csv, write_parquet, write_single_parquet

__all__ = [
    "LOG_COLUMNS", "clean", "events", "preview", "read_device_log", "read_mixed_device_log", "CONTENT_SCHEMA",
    "PROFILE_SCHEMA", "read_content_map", "read_content_map_parquet", "read_profile",
    "read_checked_csv", "read_usage_input", "readable", "rows_to_frame", "with_length_seconds", "register_views", "write_bucketed", "write_csv",
    "write_parquet", "write_single_parquet",
]
