"""Queries over the test tables, each beside the SQL that checks it."""

from registered.book import Entry, all_entries

__all__ = ["Entry", "all_entries"]
