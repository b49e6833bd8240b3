"""Exact quantiles per group without holding a group in one task.

``percentile`` and ``percentile_disc`` keep every distinct value of a group in
one aggregation buffer, and ``percentile_approx`` is off by a fraction of the
group size.  Here the approximate sketch only brackets each wanted rank; the
rows outside the brackets are counted, the few inside are ranked exactly:

1. one aggregation: group size and, per probability, a value just below and
   just above the wanted rank (bounded sketch, combined map-side);
2. one lookup join and one aggregation: values inside a bracket are kept as
   they are, values between brackets collapse into one counted row per gap;
3. a running count over what is left of each group.

A bracket reaches four sketch errors (4/``accuracy`` of the group) to either
side, so with the default accuracy step 3 sees under 1/10000 of a large group
per probability.  A group of up to ``accuracy`` (or ``small_group``, if that is
more) values is ranked whole.  A sketch that missed its rank raises instead of
giving a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell.plans.skew import salted_lookup

DISCRETE = "disc"
LINEAR = "cont"

_V, _N, _EDGES, _REP, _GAP, _CNT, _CUM = "__v", "__n", "__edges", "__rep", "__gap", "__cnt", "__cum"


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    *,
    method: str = DISCRETE,
    accuracy: int = 100_000,
    small_group: int = 0,
    salts: int = 16,
    carry: dict[str, Column] | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """One row per group: ``keys``, ``n`` (non-NULL values), one column per quantile.

    ``quantiles`` maps output name to probability.  ``disc`` returns the
    smallest element whose rank share reaches the probability (the lower
    median for 0.5), integers and decimals in their own type; ``cont``
    interpolates linearly between neighbours, in doubles.
    A group whose values are all NULL appears with ``n`` = 0 and NULLs.
    ``carry`` names further aggregates over ``df`` (means, say) to be computed
    in the first pass and returned too, which saves them a scan of their own.
    ``few_groups`` says the keys have a fixed handful of values, so that the
    rows need not be shuffled to meet their brackets.
    """
    if method not in (DISCRETE, LINEAR):
        raise ValueError(f"unknown method {method!r}")
    keys = list(keys)
    probabilities = list(quantiles.values())
    extra = {f"__carry_{name}": c for name, c in (carry or {}).items()}
    kept = list(extra)
    kind = df.schema[value].dataType
    if method == LINEAR or not isinstance(kind, (T.IntegralType, T.DecimalType)):
        kind = T.DoubleType()
    measured = df.withColumn(_V, F.col(value).cast(kind))
    slim = measured.select(*keys, _V)

    # From this size on a bracket spans four ranks and more to either side,
    # which covers the neighbour that interpolation needs.
    small_group = max(small_group, accuracy)
    margin = 4.0 / accuracy
    wanted = [min(1.0, max(0.0, p + side * margin)) for p in probabilities for side in (-1, 1)]
    sketch = F.percentile_approx(_V, wanted, accuracy)
    whole = F.array(*[F.min(_V) if i % 2 == 0 else F.max(_V) for i in range(len(wanted))])
    brackets = measured.groupBy(*keys).agg(
        F.count(_V).alias(_N),
        F.when(F.count(_V) <= small_group, whole).otherwise(sketch).alias(_EDGES),
        *[c.alias(name) for name, c in extra.items()],
    )
    values = slim.filter(F.col(_V).isNotNull())
    if keys:
        placed = salted_lookup(values, brackets, keys, [*keys, _V], salts, few_keys=few_groups)
    else:
        only = brackets.select(F.struct(_N, _EDGES, *kept)).scalar()
        placed = values.withColumn("__b", only).select(_V, *[f"__b.{c}" for c in (_N, _EDGES, *kept)])

    low = [_widened(F.get(_EDGES, F.lit(2 * i)), kind, F.try_subtract) for i in range(len(probabilities))]
    high = [_widened(F.get(_EDGES, F.lit(2 * i + 1)), kind, F.try_add) for i in range(len(probabilities))]
    inside = F.lit(False)
    for lo, hi in zip(low, high):
        inside = inside | F.col(_V).between(lo, hi)
    # A gap is named after the highest bracket edge below it (NULL: none), so
    # that (edge, gap last) sorts like the values it stands for.
    edge_below = F.greatest(*[F.when(hi < F.col(_V), hi) for hi in [*high, F.lit(None).cast(kind)]])
    cells = (
        placed.select(
            *keys,
            _N,
            *kept,
            F.when(inside, F.col(_V)).otherwise(edge_below).alias(_REP),
            (~inside).cast("int").alias(_GAP),
        )
        .groupBy(*keys, _N, *kept, _REP, _GAP)
        .agg(F.count(F.lit(1)).alias(_CNT))
    )
    running = W.partitionBy(*keys).orderBy(F.col(_REP).asc_nulls_first(), F.col(_GAP)).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    ranked = cells.withColumn(_CUM, F.sum(_CNT).over(running))

    if method == DISCRETE:
        picked = {name: _element(_rank(p), kind).cast(kind) for name, p in quantiles.items()}
    else:
        picked = {name: _interpolated(p) for name, p in quantiles.items()}
    answers = ranked.groupBy(*keys).agg(
        F.max(_N).alias("n"),
        *[F.first(c).alias(name) for c, name in zip(kept, carry or {})],
        *[c.alias(k) for k, c in picked.items()],
    )
    if not keys:
        # A global aggregate always yields its one row; only n needs a value.
        return answers.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    # The edges of an empty group are NULL.  Naming them, and not a literal,
    # asks for the very aggregate used above, whose shuffle is then reused.
    empty = brackets.filter(F.col(_N) == 0).select(
        *keys,
        F.col(_N).alias("n"),
        *[F.col(c).alias(name) for c, name in zip(kept, carry or {})],
        *[F.get(_EDGES, F.lit(0)).alias(k) for k in quantiles],
    )
    return answers.unionByName(empty)


def _rank(p: float) -> Column:
    """1-based rank of the discrete quantile in a group of ``_N`` values."""
    # Rounded first: 30 * 0.1 must not become rank 4.
    return F.greatest(F.ceil(F.round(F.col(_N) * F.lit(p), 9)), F.lit(1))


def _widened(edge: Column, kind: T.DataType, move) -> Column:
    """A bracket edge moved outwards by what the sketch, which counts in doubles, may have rounded it."""
    if isinstance(kind, T.DoubleType):
        return edge
    if isinstance(kind, T.DecimalType):
        rounding = F.coalesce((F.abs(edge).cast("double") * F.lit(1e-14)).try_cast(kind), F.lit(0).cast(kind))
        slack = rounding + F.lit(f"1e-{kind.scale}").cast(kind)
        return F.coalesce(move(edge, slack).try_cast(kind), edge)
    slack = F.abs(F.shiftright(edge.cast("bigint"), 50)) + F.lit(1)
    return F.coalesce(move(edge.cast("bigint"), slack), edge.cast("bigint"))


def _element(rank: Column, kind: T.DataType = T.DoubleType()) -> Column:
    """Value at a 1-based rank: the lowest cell whose running count reaches it."""
    hit = F.min(F.when(F.col(_CUM) >= rank, F.struct(_CUM, _GAP, F.col(_REP).alias("rep"))))
    missed = F.raise_error(F.lit("quantile bracket missed its rank; raise `accuracy`")).cast(kind)
    return F.when(hit[_GAP] == 1, missed).otherwise(hit["rep"])


def _interpolated(p: float) -> Column:
    position = (F.col(_N) - F.lit(1)) * F.lit(p)
    below = F.floor(position)
    lower = _element(below + F.lit(1))
    upper = _element(F.least(below + F.lit(2), F.col(_N)))
    share = F.max(position - below)
    return lower + (upper - lower) * share
