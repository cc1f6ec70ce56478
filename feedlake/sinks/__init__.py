"""Writing snapshots, publishing a day, and the run ledger."""

from feedlake.sinks.ledger import Ledger
from feedlake.sinks.manifest import DayBusy, LeaseLost, Publication, UnknownLineage, publish, read_manifest
from feedlake.sinks.snapshot import table_path, write_snapshot

__all__ = [
    "DayBusy",
    "LeaseLost",
    "Ledger",
    "Publication",
    "UnknownLineage",
    "publish",
    "read_manifest",
    "table_path",
    "write_snapshot",
]
