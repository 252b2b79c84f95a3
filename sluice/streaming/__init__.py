"""Structured Streaming entry points (extension X1, not part of parity)."""

from sluice.streaming.ingest_stream import ingest_stream  # noqa: F401
