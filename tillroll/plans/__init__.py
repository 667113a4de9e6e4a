"""Named queries: ``loyalty`` (L01-L12), ``delivery`` (A01-E02 and the
``*_intended`` corrections), the registry used by ``__spark_entry__`` and the
DuckDB oracle SQL."""
