"""A training corpus from ``documents``, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewell.llm.ledger import table
from sievewell.llm.minhash import Likeness, keep_one_each
from sievewell.llm.mixing import mix, with_rates
from sievewell.llm.pii import fit_boosted, redact
from sievewell.llm.queries import MIX_TARGETS, labelled_domains
from sievewell.llm.store import stored
from sievewell.llm.toxicity import drop_toxic, fit_grammar
from sievewell.llm.wu_manber import drop_contaminated


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar, fitted on the labels, calls toxic go."""
    return drop_toxic(docs, fit_grammar(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles stays."""
    return keep_one_each(docs, Likeness(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return redact(docs, fit_boosted(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that meet the targets, and how many copies of a document they come to; documents with none are not in the mix."""
    rated, _ = mix(docs, labelled_domains(spark, sf_dir), MIX_TARGETS)
    return with_rates(docs, rated).where("copies > 0")


STAGES = [
    ("toxicity", toxicity),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", privacy),
    ("mixing sources to target weights", mixing),
]

#: Fitted models and hash-based candidates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
