"""marketlens: marketplace seller analytics as PySpark DataFrame jobs.

functions/  scalar cleaning and date functions, fixed label maps
operators/  flatten, project, filters, joins, aggregates, windows, sorts, unions, quality checks
sources/    typed readers for landed JSON / CSV, the supplied test tables
sinks/      Parquet tables at a path: append, window reload, versioned upsert, exports
plans/      user-level jobs and the registered queries with their DuckDB oracles
streaming/  the incremental order log as a catch-up file stream
"""
