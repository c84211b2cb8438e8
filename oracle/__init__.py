"""DuckDB oracle SQL, one statement per query key (see ``oracle.sql``)."""
