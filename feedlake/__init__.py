"""Landing daily delimited feeds as typed Parquet snapshots, on Spark."""

from feedlake.plans.ingest import LoadConfig, LoadResult, daily_load
from feedlake.session import build_session, configure

__all__ = ["LoadConfig", "LoadResult", "build_session", "configure", "daily_load"]
