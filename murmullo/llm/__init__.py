"""Corpus operators for training data: dedup, mixing, decontamination, tokens, archives."""
