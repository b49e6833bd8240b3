"""Join helper for keys that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
#: Keys with this share of all facts or more are hot; there can be no more than 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 64
_TRACKED = 1024


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> Column:
    """Hashes of the keys that hold ``share`` of all facts or more, as an array found when the query runs.

    One pass over the key columns with a heavy-hitter sketch, merged map-side.
    It misses no such key while ``share`` is above 1/700; one that is a little
    rarer may be named too, which only costs it some copies.
    """
    most = round(1 / share)
    hashed = facts.select(F.xxhash64(*keys).alias("key"))
    found = hashed.agg(F.expr(f"approx_top_k(key, {most}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    frequent = F.filter("top", lambda t: t["count"] >= F.col("n") * F.lit(share))
    return found.select(F.transform(frequent, lambda t: t["item"]).alias("hot")).scalar()


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    salts: int = 16,
    how: str = "inner",
    few_keys: bool = False,
    only_hot: bool = False,
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` holding one row per key (NULL is a key too).

    A key with a third of all facts would land in one shuffle partition; here
    every lookup row is repeated ``salts`` times and each fact picks its copy
    by hashing ``spread_by``, so the key is spread over ``salts`` partitions.
    No size is assumed for the lookup: Spark still broadcasts it by itself if
    its statistics allow that.  Facts alike in ``spread_by`` share a copy;
    adaptive skew-join splitting takes care of those.

    ``few_keys`` is for a key with a fixed handful of values (a flag, a code
    list): the lookup is then broadcast and the facts are not moved at all.

    ``only_hot`` repeats the rows of hot keys only (see ``hot_keys``), all
    others are joined once: for a large lookup, at the price of one more pass
    over the keys of the facts.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_lookup does not support {how!r}")
    renamed = {k: f"__lookup_{k}" for k in keys}
    if few_keys:
        pairs = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
        small = F.broadcast(lookup.withColumnsRenamed(renamed))
        return facts.join(small, reduce(lambda a, b: a & b, pairs), how).drop(*renamed.values())
    copies = F.array(*[F.lit(i) for i in range(salts)])
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    if only_hot:
        hot = hot_keys(facts, keys)
        # Both sides hash the same types, or a hot key would meet only its first copy.
        as_facts = [F.col(renamed[k]).cast(facts.schema[k].dataType) for k in keys]
        copies = F.when(F.array_contains(hot, F.xxhash64(*as_facts)), copies).otherwise(F.array(F.lit(0)))
        salt = F.when(F.array_contains(hot, F.xxhash64(*keys)), salt).otherwise(F.lit(0))
    copies = F.explode(copies)
    spread = lookup.withColumnsRenamed(renamed).select("*", copies.alias(f"__lookup{_SALT}"))
    salted = facts.withColumn(_SALT, salt)
    same_key = reduce(
        lambda condition, k: condition & F.col(k).eqNullSafe(F.col(renamed[k])),
        keys,
        F.col(_SALT) == F.col(f"__lookup{_SALT}"),
    )
    return salted.join(spread, same_key, how).drop(_SALT, f"__lookup{_SALT}", *renamed.values())
