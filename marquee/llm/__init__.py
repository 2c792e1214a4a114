"""Operators for preparing training data (near-duplicates, filters, packing, ...).

Nothing outside this folder imports it.  ``queries.QUERIES`` and
``queries.ORACLE`` hold its registered queries and their SQL.
"""
