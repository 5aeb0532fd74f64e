"""Corpus operators for training-data work: one module per operator, plus ``queries`` which registers them."""
