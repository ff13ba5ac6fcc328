"""Registered queries (``catalog``) and the SQL text of the derived tables."""
