"""Composed queries, the mapping of the driver's tables, and the query registry."""
