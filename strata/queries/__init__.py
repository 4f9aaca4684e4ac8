"""Registered queries (``spark_side``) and their DuckDB oracle SQL (``oracle``)."""
