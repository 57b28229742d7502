"""Operators of a large-scale training-data pipeline (one module each).

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
