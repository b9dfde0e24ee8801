"""Incremental ingestion with Structured Streaming (file source → keyed store)."""

from relnorm.streaming.incremental import ingest_new_files

__all__ = ["ingest_new_files"]
