"""Operators for preparing training data: search, cleaning, scans, deduplication, encoding.

Nothing else in the library imports this package.  Every operator reads a DataFrame and
returns one; ``catalog`` has one query per operator over the given tables.
"""
