"""Operators of a training-data pipeline: formatting, counting, dedup, filtering.

Nothing outside this package imports it. ``queries`` holds the registered
queries and their SQL.
"""
