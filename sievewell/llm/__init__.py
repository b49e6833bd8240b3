"""Operators for preparing training text, one module each; queries are in ``llm.queries``.

Nothing else in the library imports this package.
"""
