"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage; it only uses the general
session helpers. Each module states the method it follows, its parameters and
the defined result of every edge case. ``queries`` holds the registered
queries and their SQL.
"""
