"""Named queries (the registry read by ``__spark_entry__``) and their DuckDB oracles."""
