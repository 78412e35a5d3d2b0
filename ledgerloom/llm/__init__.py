"""Operators that prepare text for training, and their queries.

Nothing else in the library imports this package.
"""
