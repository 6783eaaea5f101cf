"""Operators for large training-text corpora.

Each module holds one operator with its own interface; ``queries`` applies them to the given tables.
"""
