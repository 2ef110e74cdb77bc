"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage. Each module holds one operator and the
digest its registered query returns; ``queries.py`` lists the queries and their SQL.
"""
