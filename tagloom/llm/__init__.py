"""Operators for building training corpora.

One module per operator; ``catalog`` registers the queries and their SQL.
Nothing outside this subpackage imports it.
"""
