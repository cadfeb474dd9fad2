"""Structured Streaming runners (the incremental order log)."""
