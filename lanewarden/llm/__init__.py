"""Operators of a training-data pipeline over documents, vectors and web pages.

Each module holds one operator with its general interface; ``queries`` registers the thin
``opN_<name>`` queries that derive their digest columns from the operators' rows. Nothing else in
the library imports this package.
"""
