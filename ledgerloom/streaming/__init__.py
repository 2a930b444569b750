"""Structured Streaming entry points (incremental fact loads)."""

from .incremental import start_fact_stream, upsert_batch  # noqa: F401
