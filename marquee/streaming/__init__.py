"""Structured Streaming ingestion of newly arrived raw catalog files."""

from marquee.streaming.ingest import catalog_stream, load_batch

__all__ = ["catalog_stream", "load_batch"]
