"""Operators for preparing text corpora: filters, de-duplication, tokens, shards."""
