"""Training-data operators: scoring, filtering, deduplication, tokenizing and packing of text corpora.

Nothing outside this subpackage imports it.
"""
