"""Training-data operators: deduplication, quality, mixing, tokenising and search.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; ``queries.py`` holds the thin registered queries.
"""
