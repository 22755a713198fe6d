"""Operators for large training-data corpora.

Each module holds one operator with a general interface; `queries` applies them to the
given tables and derives the digest columns.  Nothing outside this package imports it.
"""
