"""Spark-first cleaning, ranking, summarising and stream routing of records.

Everything here takes and returns DataFrames, uses built-in functions only and
leaves physical planning to Catalyst.  Functions are parameterised by column
names; the domain presets (film catalogue, shop events) live in ``plans``.
"""
