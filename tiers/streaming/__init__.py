"""Streaming: the bronze ingest as an incremental file stream."""

from tiers.streaming.ingest import ingest_available, stream_csv

__all__ = ["ingest_available", "stream_csv"]
