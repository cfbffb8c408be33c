"""Training-data operators: mixing, PII surrogates, toxicity, sharding, dedup, packing, extraction.

Nothing else in the library imports this subpackage.
"""
