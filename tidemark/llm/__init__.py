"""Operators of a training-data pipeline: cleaning, deduplication, labelling and tokens of large text corpora."""
