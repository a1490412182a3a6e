"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; ``queries.py`` holds its
registered queries. Every operator module documents its method, its parameters
and its result for nulls, empty texts, ties, repeated rows and empty tables.
"""
