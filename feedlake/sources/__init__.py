"""Finding and reading payloads, and the schema registry."""

from feedlake.sources.discover import discover, route_kind, union_sources
from feedlake.sources.registry import (
    load_registry,
    prune_schema,
    registry_entries,
    registry_key,
    schema_for,
    split_types,
)
from feedlake.sources.scan import null_tokens, scan_delimited, scan_lines, sniff_first_lines

__all__ = [
    "discover",
    "load_registry",
    "null_tokens",
    "prune_schema",
    "registry_entries",
    "registry_key",
    "route_kind",
    "scan_delimited",
    "scan_lines",
    "schema_for",
    "sniff_first_lines",
    "split_types",
    "union_sources",
]
