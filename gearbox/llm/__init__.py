"""Operators for preparing large text corpora: duplicates, personal data,
scores, mixing, token counts and packing.

Nothing else in the library imports this package.  ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold its registered queries.
"""
