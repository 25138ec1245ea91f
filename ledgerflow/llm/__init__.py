"""Operators of a training-data pipeline over documents and embeddings.

Nothing outside this folder imports it; ``queries`` holds the registered queries and their SQL.
"""
