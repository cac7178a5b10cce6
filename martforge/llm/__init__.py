"""Operators of a training-data pipeline: archives, deduplication, mixing,
privacy, quality, toxicity, secrets and tokenisation over document tables."""
