"""Training-data operators: tokenising, packing, dedup, classifiers, scans.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries of its ten operators.
"""
