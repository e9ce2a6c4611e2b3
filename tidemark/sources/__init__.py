"""Readers (declared-schema CSV / JSON, fixture views) and writers."""
