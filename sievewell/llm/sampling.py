"""Bounded samples of labelled rows, to fit models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def share_of(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` of the rows, by a hash of ``key``; all of them if they are no more. No shuffle, the same every time."""
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(_PARTS)) < int(_PARTS * most / total))


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(doc_id, text, ``more``, label) of about ``most`` labelled documents outside the held-out fold.

    A document labelled more than once has its largest label; NULL ids and
    labels are no labels.
    """
    rows = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    rows = share_of(rows.where(fold(F.col("doc_id"), folds) != held_out), "doc_id", most)
    picked = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *more)
    # About ``most`` rows of two numbers at the most.
    return texts.join(F.broadcast(picked), "doc_id")
