"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries`` registers the thin
queries that apply them to the given tables.
"""
