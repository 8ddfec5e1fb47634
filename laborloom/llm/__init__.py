"""Operators of a training-data pipeline over tables of documents and conversations.

Nothing else in the library imports this package. Every operator takes and returns
DataFrames; ``queries`` holds the registered queries, ``oracle`` the SQL they must match.
"""
