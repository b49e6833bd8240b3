"""Mixing to target weights by soft membership, in column expressions and aggregates only.

A classifier fitted on a labelled table gives every document a probability per
domain.  The document then counts with its tokens towards all domains, and
nonnegative rates (how often a document is to be used) are fitted so that the
expected tokens of each domain meet their targets: least squares over relative
misses plus a small pull towards rate 1, by projected gradient.  One step of it
is one aggregate of as many sums as there are domains; the rate itself is an
expression of those sums, so nothing is kept per document but its tokens and
probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewell.llm.sampling import share_of
from sievewell.llm.store import stored

#: Slots of hashed words, and labelled documents to learn from at most.
SLOTS = 1 << 12
MOST_LABELLED = 10_000
#: Words after which evidence counts no further, so that long texts keep soft memberships.
EVIDENCE = 40.0
STEPS = 16
#: Weight of keeping rates at 1.
PULL = 0.02
#: Most ids whose rates are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), "\n\t\r\f", "    "), " ")


def slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


@dataclass(frozen=True)
class Classifier:
    """Per domain the log prior and a log probability per slot."""

    domains: tuple[str, ...]
    prior: tuple[float, ...]
    table: tuple[tuple[float, ...], ...]


def fit_classifier(documents: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", domain: str = "domain", most: int = MOST_LABELLED) -> Classifier:
    """Naive Bayes over hashed words of about ``most`` labelled documents.

    The driver gets one row per slot and domain.  NULL ids and domains are no
    labels; of several labels the smallest counts.
    """
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(domain).cast("string").alias("domain")).dropna()
    picked = share_of(rows, "doc_id", most).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    words = texts.select("domain", F.explode(words_of(F.col("text"))).alias("w")).where("w != ''")
    counts = words.groupBy("domain", slot(F.col("w")).alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r.domain: r.n for r in texts.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = tuple(sorted(sizes))
    tables = {d: [0.5] * SLOTS for d in domains}
    for r in counts:
        tables[r.domain][r.slot] += r.n
    total = sum(sizes.values())
    return Classifier(
        domains,
        tuple(math.log(sizes[d] / total) for d in domains),
        tuple(tuple(math.log(x / sum(tables[d])) for x in tables[d]) for d in domains),
    )


def memberships(documents: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tokens, p): one row per id with its words and an array of probabilities in the order of the domains.

    Rows sharing an id count as one document.  A text without words has no
    tokens and the prior as probabilities.
    """
    count = len(classifier.domains)
    words = documents.select(F.col(doc_id).alias("doc_id"), F.explode(words_of(F.col(text).cast("string"))).alias("w"))
    hashed = words.select("doc_id", F.when(F.col("w") != "", slot(F.col("w"))).alias("s"))
    sums = []
    for k in range(count):
        values = F.split(F.lit(",".join(f"{v:.9g}" for v in classifier.table[k])), ",").cast("array<double>")  # folded to one constant
        sums.append(F.coalesce(F.sum(F.element_at(values, F.col("s") + 1)), F.lit(0.0)).alias(f"l{k}"))
    summed = hashed.groupBy("doc_id").agg(F.count("s").alias("tokens"), *sums)
    shrink = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.col("tokens"), F.lit(1)))
    scores = [F.col(f"l{k}") * shrink + F.lit(classifier.prior[k]) for k in range(count)]
    top = F.greatest(*scores) if count > 1 else scores[0]
    odds = summed.select("doc_id", "tokens", F.array(*[F.exp(s - top) for s in scores]).alias("e"))
    whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return odds.select("doc_id", "tokens", F.transform("e", lambda x: x / whole).alias("p"))


@dataclass(frozen=True)
class Rates:
    """Residuals of every step; the rate of a document is an expression of its probabilities alone."""

    steps: tuple[tuple[float, ...], ...]
    step_size: float

    def of(self, p: Column) -> Column:
        if not self.steps:
            return F.lit(1.0)
        steps = F.array(*[F.array(*[F.lit(r) for r in residuals]) for residuals in self.steps])

        def step(rate: Column, residuals: Column) -> Column:
            pull = F.lit(PULL) * (rate - 1.0)
            for k in range(len(self.steps[0])):
                pull = pull + F.get(residuals, F.lit(k)) * F.get(p, F.lit(k))
            return F.greatest(F.lit(0.0), rate - F.lit(self.step_size) * pull)

        return F.aggregate(steps, F.lit(1.0), step)


def fit_rates(members: DataFrame, targets: Mapping[str, float], classifier: Classifier) -> Rates:
    """Projected gradient steps; ``targets`` are shares of all tokens by domain (others 0).

    They are scaled to sum to 1 over the domains that the classifier knows, so
    that the mix keeps its size where a target's domain has no documents.
    Without a target for any of them all rates are 1.

    The misses are relative to the square roots of the domains' own shares,
    which makes the steps of rare domains as large as those of common ones.
    ``members`` should be stored, it is read once per step.
    """
    count = len(classifier.domains)
    expected = [F.sum(F.col("tokens") * F.get("p", k)).alias(f"x{k}") for k in range(count)]
    first = members.agg(F.sum("tokens").alias("t"), *expected).first()
    total, weight = float(first.t or 0), sum(targets.get(d, 0.0) for d in classifier.domains)
    if not total or not weight or not count:
        return Rates((), 0.0)
    goal = [targets.get(d, 0.0) / weight for d in classifier.domains]
    scale = [1 / max(first[f"x{k}"] / total, 1e-6) for k in range(count)]
    size = 1 / (1 + PULL)
    steps: list[tuple[float, ...]] = []
    now = [first[f"x{k}"] / total for k in range(count)]
    for _ in range(STEPS):
        steps.append(tuple((now[k] - goal[k]) * scale[k] for k in range(count)))
        rates = Rates(tuple(steps), size)
        weighted = members.select("tokens", "p", rates.of(F.col("p")).alias("rate"))
        sums = weighted.agg(*[F.sum(F.col("rate") * F.col("tokens") * F.get("p", k)).alias(f"x{k}") for k in range(count)]).first()
        now = [sums[f"x{k}"] / total for k in range(count)]
    return Rates(tuple(steps), size)


def mix(documents: DataFrame, labelled: DataFrame, targets: Mapping[str, float], doc_id: str = "doc_id", text: str = "text", domain: str = "domain") -> tuple[DataFrame, Classifier]:
    """(doc_id, tokens, p, rate, copies), one row per id, and the classifier naming the domains of ``p``.

    ``copies`` realises the rate: its whole part, and one more for the share of
    ids that its fraction says, by a hash of the id.  Without labelled
    documents all rates are 1 and ``p`` is empty.
    """
    classifier = fit_classifier(documents, labelled, doc_id, text, domain)
    members = stored(memberships(documents, classifier, doc_id, text) if classifier.domains else _unlabelled(documents, doc_id, text), "memberships")
    rates = fit_rates(members, targets, classifier)
    rated = members.withColumn("rate", rates.of(F.col("p")))
    chance = F.pmod(F.xxhash64(F.lit("copy"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate")
    return rated.withColumn("copies", (whole + (chance < F.col("rate") - whole).cast("bigint")).cast("bigint")), classifier


def _unlabelled(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    size = F.size(F.filter(words_of(F.col(text).cast("string")), lambda w: w != ""))
    return documents.groupBy(F.col(doc_id).alias("doc_id")).agg(F.sum(size).alias("tokens")).withColumn("p", F.array().cast("array<double>"))


def with_rates(documents: DataFrame, rated: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``documents`` with their rate and copies; columns of these names are replaced."""
    lookup = rated.select(F.col("doc_id").alias("__id"), "rate", "copies")
    if lookup.count() <= MOST_BROADCAST:
        lookup = F.broadcast(lookup)
    return documents.drop("rate", "copies").join(lookup, F.col(doc_id).eqNullSafe(F.col("__id")), "left").drop("__id")
