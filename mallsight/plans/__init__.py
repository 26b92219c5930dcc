"""Composite plans: period helpers, reports and the registry of named queries."""
