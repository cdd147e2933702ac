"""Operators that prepare training text. Nothing else in the library imports this subpackage.

Each operator takes a DataFrame and the names of the columns it works on, and keeps all others. Column names
that start with two underscores are the operators' own while they work.
"""
