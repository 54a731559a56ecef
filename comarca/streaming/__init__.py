"""Incremental ingestion: new files once, late periods as they come."""

from .incremental import ingest_available, upsert_latest

__all__ = ["ingest_available", "upsert_latest"]
