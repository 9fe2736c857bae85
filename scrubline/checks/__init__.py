"""One query per operator over the test tables, and the same in SQL for DuckDB."""
