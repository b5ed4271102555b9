"""Operators of a training-data pipeline over ``documents``-like tables.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is present.
"""
