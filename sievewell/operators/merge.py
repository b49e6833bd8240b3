"""Keyed cache lookups and merges: JON1-JON4, FLT11."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewell.operators.cleaning import one_per_key
from sievewell.plans.skew import salted_lookup


def request_list(spark: SparkSession, ids: Sequence[int], key: str = "id", position: str = "position") -> DataFrame:
    """A caller's id list as rows numbered from 0."""
    return spark.createDataFrame([(i, int(k)) for i, k in enumerate(ids)], f"{position} bigint, {key} bigint")


def usable_requests(requested: DataFrame, key: str = "id") -> DataFrame:
    """FLT11: drop non-positive (and NULL) keys."""
    return requested.filter(F.col(key) > 0)


def missing_keys(requested: DataFrame, cache: DataFrame, key: str = "id") -> DataFrame:
    """JON1: requested rows whose key is not cached."""
    return requested.join(cache.select(key), key, "left_anti")


def merge_fresh(
    cache: DataFrame, fresh: DataFrame, key: str = "id", latest: Sequence[Column | str] | None = None
) -> DataFrame:
    """JON2: one row per key: the fresh one where there is one, else the cached one.

    Several fresh rows of a key are reduced to the one that sorts first in
    ``latest``, several cached ones likewise if they have its columns;
    remaining ties, and rows without such an order, go by all other columns.
    """
    fresh = one_per_key(fresh, key, latest)
    kept = one_per_key(cache.join(fresh.select(key), key, "left_anti"), key)
    return fresh.unionByName(kept, allowMissingColumns=True)


def lookup_in_order(
    requested: DataFrame, available: DataFrame, key: str = "id", position: str = "position"
) -> DataFrame:
    """JON3: available rows in request order; a key asked for twice comes twice."""
    return _found(requested, available, key, position).orderBy(position)


def _found(requested: DataFrame, available: DataFrame, key: str, position: str) -> DataFrame:
    """Requests with their rows; a key asked for very often is spread, all others are joined once."""
    return salted_lookup(requested.select(position, key), available, [key], [position], only_hot=True)


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """JON4: ``primary``, or ``fallback`` when ``primary`` has no row.

    The test is an EXISTS subquery reading one row, planned once.
    """
    return primary.unionByName(fallback.filter(~primary.exists()))


def resolve_requests(
    requested: DataFrame, cache: DataFrame, fresh: DataFrame, fallback: DataFrame, key: str = "id", position: str = "position"
) -> DataFrame:
    """JON1-JON4 and FLT11 together: what a request list yields from cache, fetched
    rows and a fallback set.

    ``position`` carries the request order and is NULL for fallback rows, which
    come whole when neither cache nor fresh set has a row though something
    usable was asked for.
    """
    wanted = usable_requests(requested, key)
    known = merge_fresh(cache, fresh, key)
    found = _found(wanted, known, key, position)
    return found.unionByName(fallback.filter(~known.exists() & wanted.exists()), allowMissingColumns=True)
