"""Named queries over the stand-in tables, their DuckDB oracle SQL, and
plan inspection helpers."""
