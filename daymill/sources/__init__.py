"""Reading and writing the storage layers: landing, raw and curated."""

from daymill.sources.layers import promote, read_layer, write_table
from daymill.sources.manifest import promote_at_once, read_promoted
from daymill.sources.scans import (
    period_paths,
    read_delimited,
    read_parquet,
    scan_period,
    scan_text_period,
)

__all__ = [
    "period_paths",
    "promote",
    "promote_at_once",
    "read_delimited",
    "read_layer",
    "read_parquet",
    "read_promoted",
    "scan_period",
    "scan_text_period",
    "write_table",
]
