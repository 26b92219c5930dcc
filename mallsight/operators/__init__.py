"""Relational operators over canonical order lines (projections, filters, grain, aggregates, joins, sets)."""
