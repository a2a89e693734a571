"""Incremental loading with first-batch-wins semantics (Structured Streaming)."""

from .ingest import first_batch_wins_sink, start_ingest

__all__ = ["first_batch_wins_sink", "start_ingest"]
