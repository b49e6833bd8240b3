"""Keyed lookups and merges: order customers against a cached and a fresh customer set."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.book import register
from registered.frames import table
from sievewell.operators import merge as M

_SETS_SQL = """
requested AS (
  SELECT o_orderkey AS position, CASE WHEN o_orderpriority = '5-LOW' THEN -o_custkey ELSE o_custkey END AS id FROM orders
),
cache AS (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL SELECT c_custkey, 'old ' || c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
),
fresh AS (
  SELECT c_custkey AS id, 'new ' || c_name AS name, c_acctbal + 1 AS balance FROM customer WHERE c_acctbal > 5000
  UNION ALL SELECT c_custkey, 'new ' || c_name, c_acctbal + 2 FROM customer WHERE c_acctbal > 8000
),
merged AS (
  SELECT id, min(name) AS name, min(balance) AS balance FROM fresh GROUP BY id
  UNION ALL SELECT id, min(name), min(balance) FROM cache WHERE id NOT IN (SELECT id FROM fresh) GROUP BY id
)"""


def _sets(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    requested = orders.select(
        F.col("o_orderkey").alias("position"),
        F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("id"),
    )
    def some(condition, prefix="", more=0):
        name = F.concat(F.lit(prefix), F.col("c_name"))
        return customers.filter(condition).select(F.col("c_custkey").alias("id"), name.alias("name"), (F.col("c_acctbal") + more).alias("balance"))

    # Some keys come twice in either set.
    cache = some(F.col("c_mktsegment") != "MACHINERY").unionAll(some(F.col("c_mktsegment") == "BUILDING", "old "))
    fresh = some(F.col("c_acctbal") > 5000, "new ", 1).unionAll(some(F.col("c_acctbal") > 8000, "new ", 2))
    return requested, cache, fresh


@register(
    "missing_keys",
    "JON1 FLT11",
    f"WITH {_SETS_SQL} SELECT position, id FROM requested WHERE id > 0 AND id NOT IN (SELECT id FROM cache)",
)
def missing_keys(spark, sf_dir):
    requested, cache, _ = _sets(spark, sf_dir)
    return M.missing_keys(M.usable_requests(requested), cache)


@register("merge_fresh", "JON2", f"WITH {_SETS_SQL} SELECT id, name, balance FROM merged")
def merge_fresh(spark, sf_dir):
    _, cache, fresh = _sets(spark, sf_dir)
    return M.merge_fresh(cache, fresh)


@register(
    "lookup_in_order",
    "JON3 FLT11",
    f"WITH {_SETS_SQL} SELECT position, id, name, balance FROM requested JOIN merged USING (id) WHERE id > 0",
)
def lookup_in_order(spark, sf_dir):
    requested, cache, fresh = _sets(spark, sf_dir)
    return M.lookup_in_order(M.usable_requests(requested), M.merge_fresh(cache, fresh))


@register(
    "fallback_used",
    "JON4",
    "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier",
)
def fallback_used(spark, sf_dir):
    """No customer has such a balance, so the suppliers stand in."""
    _, cache, _ = _sets(spark, sf_dir)
    return M.with_fallback(cache.filter(F.col("balance") > 1e12), _suppliers(spark, sf_dir))


@register("fallback_unused", "JON4", f"WITH {_SETS_SQL} SELECT id, name, balance FROM cache")
def fallback_unused(spark, sf_dir):
    _, cache, _ = _sets(spark, sf_dir)
    return M.with_fallback(cache, _suppliers(spark, sf_dir))


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )


@register(
    "resolve_requests",
    "JON1 JON2 JON3 JON4 FLT11",
    f"WITH {_SETS_SQL} SELECT position, id, name, balance FROM requested JOIN merged USING (id) WHERE id > 0",
)
def resolve_requests(spark, sf_dir):
    requested, cache, fresh = _sets(spark, sf_dir)
    return M.resolve_requests(requested, cache, fresh, _suppliers(spark, sf_dir))


@register(
    "resolve_nothing_usable",
    "JON4 FLT11",
    "SELECT o_orderkey AS position, o_custkey AS id, '' AS name, 0.0::DOUBLE AS balance FROM orders WHERE false",
)
def resolve_nothing_usable(spark, sf_dir):
    """Nothing known and nothing usable asked for: not even the fallback comes."""
    requested, cache, fresh = _sets(spark, sf_dir)
    unknown = requested.withColumn("id", -F.abs("id"))
    none = F.col("balance") > 1e12
    return M.resolve_requests(unknown, cache.filter(none), fresh.filter(none), _suppliers(spark, sf_dir))
