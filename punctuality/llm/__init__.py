"""Operators for preparing text corpora: near and exact repeats, cleaning, tokens, packing, scores."""
