"""Substring searches over delimited text columns: FLT5, FLT6."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(
    df: DataFrame,
    contains: Mapping[str, Sequence[str]] | None = None,
    equals: Mapping[str, object] | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Rows where every listed term occurs in its column and every equality holds.

    All conditions reach a columnar scan as pushed filters.
    """
    tests = [F.col(c).contains(term) for c, terms in (contains or {}).items() for term in terms]
    tests += [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    found = df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
    return found.orderBy(*order) if order else found
