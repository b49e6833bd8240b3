"""URL rules by Bloom filter cascades over all keys of the corpus.

A key is a host suffix followed by the start of a path.  A cascade decides
whether a key is listed: its first level holds the listed keys, its second
those keys of the corpus that pass the first though they are not listed, its
third the listed keys that pass the second, and so on until nothing passes by
mistake.  As the second level saw *every* key of the corpus, the answer is
exact for all of them, and no URL is joined with the list: the levels are
64-bit words inside the query's expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewell.llm.store import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys that one cascade is built for; its filters stay below about 2 MB.  A larger list takes several cascades in turn.
MOST_LISTED = 500_000
#: A later level of at most so many keys lets 1 in 1000 by instead of half, which ends the cascade sooner.
SMALL_LEVEL = 4_096


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` for a host with its subdomains and all paths starting with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    hashes: int
    seed: int

    def might_hold(self, key: Column) -> Column:
        bits = 64 * len(self.words)
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one constant
        places = F.array(*[F.pmod(F.xxhash64(F.lit(self.seed), F.lit(i), key), F.lit(bits)) for i in range(self.hashes)])
        return F.forall(places, lambda at: F.getbit(F.element_at(table, (at / 64).cast("int") + 1), (at % 64).cast("int")) == 1)


@dataclass(frozen=True)
class Cascade:
    """Levels in turn: the first level that rejects a key settles it, odd ones as unlisted, even ones as listed."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.levels[i].might_hold(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def _level(keys: DataFrame, bits: int, hashes: int, seed: int) -> Level:
    """One Bloom filter; a row per 64-bit word that has a bit, so the driver gets no more than the filter."""
    bits = max(64, -(-bits // 64) * 64)
    at = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "key"), F.lit(bits)) for i in range(hashes)]))
    words = keys.select(at.alias("at")).groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("bits")
    )
    filled = [0] * (bits // 64)
    for row in words.collect():
        filled[row.word] = row.bits
    return Level(tuple(filled), hashes, seed)


def fit_cascade(universe: DataFrame, listed: DataFrame, most_levels: int = 80) -> Cascade:
    """A cascade exact for every key in ``universe`` (column ``key``, repeats allowed).

    The first level is sized by how many keys there are for each listed one,
    so that fewer unlisted keys pass it than are listed: what the driver gets
    and what the later levels hold is bounded by ``listed`` (a few hundred
    thousand keys), however large the universe is.  The universe is read twice
    and never shuffled; only keys that pass the first level are.
    An empty list gives a cascade that holds nothing.
    """
    listed = stored(listed.select("key").where(F.col("key").isNotNull()).distinct(), "listed")
    count = listed.count()
    if not count:
        return Cascade(())
    keys = universe.agg(F.approx_count_distinct("key")).first()[0]
    halvings = max(1.0, math.log2(max(1.0, keys / count)) + 0.5)
    levels = [_level(listed, math.ceil(halvings / math.log(2) * count), round(halvings), seed=1)]
    passed = stored(universe.where(levels[0].might_hold(F.col("key"))).select("key").distinct(), "passed")
    # Listed keys that no url asks for need no place in the later levels.
    passing = stored(passed.join(listed, "key", "left_semi"), "inside")
    encode = stored(passed.join(listed, "key", "left_anti"), "mistaken")
    while len(levels) < most_levels:
        size = encode.count()
        if not size:
            return Cascade(tuple(levels))
        per_key, hashes = (15, 10) if size <= SMALL_LEVEL else (2, 1)
        level = _level(encode, per_key * size, hashes, seed=len(levels) + 1)
        levels.append(level)
        encode, passing = stored(passing.where(level.might_hold(F.col("key"))), "mistaken"), encode
    raise RuntimeError(f"the cascade does not end within {most_levels} levels")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return (
        F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER),
        F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1),
    )


def candidate_keys(host: Column, path: Column, hosts: Sequence[str], path_lengths: Sequence[int]) -> Column:
    """Keys under which a listed host and path start could fit, longest host first, then longest path.

    Only as many labels as the longest listed host has, and only starts as long as a listed one.
    """
    most = max((h.count(".") + 1 for h in hosts), default=0)
    labels = F.split(host, r"\.", -1)
    suffixes = [F.when(F.size(labels) >= n, F.substring_index(host, ".", -n)) for n in range(most, 0, -1)]
    keys = [
        F.when(F.length(path) >= n, F.concat(s, F.substring(path, 1, n))) if n else s
        for s in suffixes
        for n in sorted(set(path_lengths), reverse=True)
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def page_key(url: Column) -> Column:
    """The key of a single page: host and path; empty without ``://``."""
    return F.concat(*split_url(url))


def _fresh(name: str, taken: Sequence[str]) -> str:
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = "_" + name
    return name


def _mark_listed(rows: DataFrame, key: Column, listed: DataFrame, flag: str, most_listed: int) -> DataFrame:
    """``rows`` with a boolean column ``flag``: whether ``key`` is among the ``listed`` keys.

    A list above ``most_listed`` keys is dealt into parts by hash; each part
    has a cascade over the universe's keys of that part, and the rows are
    written between one part and the next.
    """
    listed = stored(listed.select(F.col("key").cast("string").alias("key")).where("key <> ''").distinct(), "list")
    parts = max(1, -(-listed.count() // most_listed))

    def part(k: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit("part"), k), F.lit(parts))

    for i in range(parts):
        ours = part(F.col("key")) == i
        cascade = fit_cascade(rows.select(key.alias("key")).where(ours), listed.where(ours))
        found = (part(key) == i) & cascade.holds(key)
        if i:
            rows = stored(rows.withColumn(flag, F.col(flag) | found), "marked")
        else:
            rows = rows.withColumn(flag, found)
            rows = stored(rows, "marked") if parts > 1 else rows
    return rows


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    blocked_hosts: Sequence[str] = (),
    url: str = "url",
    blocked_pages: DataFrame | None = None,
    most_listed: int = MOST_LISTED,
) -> DataFrame:
    """``pages`` with columns host, path, rule and verdict (columns of these names are replaced).

    The longest rule that fits wins; without one, pages of ``blocked_hosts``
    and their subdomains are blocked, so are the pages whose key is in
    ``blocked_pages`` (column ``key``, see ``page_key``; of any length), and
    the others are allowed.  A NULL or malformed url has an empty host and
    path, fits no rule and is allowed.  NULL, empty and repeated keys of a
    list change nothing.  Repeated rows are judged alike; an empty table stays
    empty.  Very long urls are judged whole.
    """
    host, path = split_url(F.col(url))
    lengths = [len(r.path) for r in rules] + ([0] if blocked_hosts else [])
    keys = candidate_keys(F.col("host"), F.col("path"), [r.host for r in rules] + list(blocked_hosts), lengths)
    parts = pages.select(host.alias("host"), path.alias("path"))
    universe = stored(parts.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    spark = pages.sparkSession
    fits_of, page_listed = _fresh("__keys", pages.columns), _fresh("__listed", pages.columns)

    def cascade(listed: Sequence[str]) -> Cascade:
        keys = F.array(*[F.lit(k) for k in listed]).cast("array<string>")
        return fit_cascade(universe, spark.range(1).select(F.explode(keys).alias("key")))

    allow = cascade([r.key for r in rules if r.verdict == "allow"])
    block = cascade([r.key for r in rules if r.verdict == "block"])
    hosts = cascade(list(blocked_hosts))
    judged = pages.withColumns({"host": host, "path": path})
    if blocked_pages is None:
        judged = judged.withColumn(page_listed, F.lit(False))
    else:
        judged = _mark_listed(judged, F.concat("host", "path"), blocked_pages, page_listed, most_listed)
    judged = judged.withColumn(fits_of, keys)
    fits = F.filter(fits_of, lambda k: allow.holds(k) | block.holds(k))
    longest = F.aggregate(fits, F.lit(None).cast("string"), lambda a, k: F.when(a.isNull() | (F.length(k) > F.length(a)), k).otherwise(a))
    judged = judged.withColumn("rule", longest)
    listed_host = F.exists(fits_of, lambda k: hosts.holds(k))
    verdict = (
        F.when(F.col("rule").isNull(), F.when(F.col(page_listed) | listed_host, F.lit("block")).otherwise(F.lit("allow")))
        .when(block.holds(F.col("rule")), F.lit("block"))
        .otherwise(F.lit("allow"))
    )
    return judged.withColumn("verdict", verdict).drop(fits_of, page_listed)
