from tradeloom.sources.discovery import (
    RawSource,
    discover_names,
    discover_paths,
    discover_tables,
    tag_columns,
)
from tradeloom.sources.raw import conform, consolidate, normalize_lineage, scan, stamp

__all__ = [
    "RawSource",
    "conform",
    "consolidate",
    "discover_names",
    "discover_paths",
    "discover_tables",
    "normalize_lineage",
    "scan",
    "stamp",
    "tag_columns",
]
