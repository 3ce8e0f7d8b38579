"""Bindings of the operator families onto the driver's test tables, and the
registered queries with their DuckDB equivalents."""
