"""Operators for training-data corpora.

One module per operator; ``queries.py`` registers them over the benchmark
tables. Nothing else in the library imports this subpackage, and it can be
removed without touching the rest.
"""
