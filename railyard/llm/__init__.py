"""Operators of a training-data pipeline over the document tables.

Nothing else in the package imports this sub-package; its queries and SQL
are in :mod:`railyard.llm.catalog`.
"""
