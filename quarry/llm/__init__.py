"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``benchmark``.

One module per operator, ``queries.py`` registers them, ``sql.py`` holds their
DuckDB oracles. Nothing outside this package imports it.
"""
