"""Typed readers for landed source data and the supplied Parquet tables."""
