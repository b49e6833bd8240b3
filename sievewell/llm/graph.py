"""Connected components of links between 64-bit nodes, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.llm.store import stored


def _downward(pairs: DataFrame) -> DataFrame:
    """Each link once, from the larger node ``u`` to the smaller ``v``."""
    return pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Alternating large-star and small-star rounds: in each, nodes hand their
    larger, then their smaller neighbours on to the smallest node they know.
    The number of rounds grows with the logarithm of the longest chain, and no
    node's neighbours are ever gathered: minima are combined before shuffles
    and joined back.  Every round is written to shared storage.
    """
    now = stored(_downward(links.select(F.col("a").alias("x"), F.col("b").alias("y"))), "links")
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _downward(both.join(least, "u").where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        then = stored(_downward(handed.union(least.select(F.col("u"), F.col("m")))), "links")
        before, state = state, _state(then)
        now = then
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
