"""Driver queries: each module pairs a Spark query with the SQL that must give the same rows."""

from warehouse_queries import checks, history, loads, mapping, streams

REGISTERED = {**mapping.QUERIES, **loads.QUERIES, **history.QUERIES, **checks.QUERIES, **streams.QUERIES}
