"""Operators for training corpora: identification, de-duplication, search, scoring, tokens and packing."""
