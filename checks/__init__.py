"""Fixture views, registered queries and their DuckDB counterparts."""
