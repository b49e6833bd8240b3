"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """A query, the SQL giving the same rows (if any), the inventory ids it shows."""

    name: str
    run: Query
    sql: str | None
    covers: tuple[str, ...]


_entries: dict[str, Entry] = {}


def register(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator adding a query; ``covers`` lists inventory ids separated by spaces."""

    def add(run: Query) -> Query:
        if name in _entries:
            raise ValueError(f"query {name} is registered twice")
        _entries[name] = Entry(name, run, sql, tuple(covers.split()))
        return run

    return add


def all_entries() -> dict[str, Entry]:
    from registered import cleaning, events, films, lookups, operations, streams  # noqa: F401

    return dict(_entries)
