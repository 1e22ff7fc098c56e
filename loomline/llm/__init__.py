"""Operators for preparing training data of language models.

Nothing outside this subpackage imports it; queries and SQL are in `queries.py`.
"""
