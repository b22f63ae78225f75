"""Operators for building training corpora: cleaning, matching, tokens and sharding."""
