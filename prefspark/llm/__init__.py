"""Operators for building training data: counting, extracting, deduplicating, mixing, sharding, scoring.

Nothing else in the library imports this subpackage. Every operator takes and returns
DataFrames; ``queries`` holds the registered ``opN_*`` queries.
"""
