"""Incremental (Structured Streaming) runner of the silver step."""

from .ingest import read_silver, stream_silver

__all__ = ["read_silver", "stream_silver"]
