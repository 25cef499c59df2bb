"""Whole jobs, and the queries that check the operators against SQL."""

from .jobs import extract_after, publish_changes, publish_table, run_bronze

__all__ = ["extract_after", "publish_changes", "publish_table", "run_bronze"]
