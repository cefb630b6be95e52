"""Training-data operators: scoring, filtering, dedup, mixing, packing, token files.

Every module is one operator with a general interface; ``queries`` holds the
thin registered queries.  Nothing else in the package imports this subpackage.
"""
