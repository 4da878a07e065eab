"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; ``queries.py`` holds the driver
queries that apply the operators to the synthetic tables.
"""
