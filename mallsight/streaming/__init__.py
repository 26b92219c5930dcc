"""Structured Streaming variant of the daily totals (STR1)."""

from .corrected import closed_totals, corrections, current_totals, run_with_corrections
from .daily import daily_totals_stream, event_time, run_daily_totals

__all__ = ["closed_totals", "corrections", "current_totals", "daily_totals_stream", "event_time", "run_daily_totals",
           "run_with_corrections"]
