"""Sinks: path-based Parquet tables (append, window reload, versioned upsert, backfill, truncate, exports)."""
