"""Corpus preparation operators for language-model training data.

Nothing outside this folder imports it; `queries.py` lists the queries and SQL.
"""
