"""Jobs (one module per source family) and the registered queries over the supplied tables."""

# Importing the query modules fills ``catalog.QUERIES`` / ``catalog.ORACLE_SQL``.
from . import queries_ads, queries_checks, queries_core, queries_landed, queries_loads, queries_sinks  # noqa: F401
