"""Incremental (Structured Streaming) form of the landing-zone ingestion."""

from tidemark.streaming.landing import ingest_landing, run_landing_once

__all__ = ["ingest_landing", "run_landing_once"]
