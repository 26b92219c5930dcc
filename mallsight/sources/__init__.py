"""Readers: driver tables, landed order documents (JSON / XML / GraphQL pages / CSV) and tables."""
