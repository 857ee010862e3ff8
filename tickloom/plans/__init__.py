"""Composed queries: each registered name is one operator from the inventory,
expressed over the fixture views, with a DuckDB oracle where SQL can say it."""
