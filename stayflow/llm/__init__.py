"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this package. ``queries`` registers one
query per operator, ``oracles`` the SQL that DuckDB can run for them.
"""
