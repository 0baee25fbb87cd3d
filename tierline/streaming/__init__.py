"""Structured Streaming side: append-only streaming tables (with triggered,
continuous and full-refresh runs), incremental keyed upserts, and
expectations counted on streams."""
