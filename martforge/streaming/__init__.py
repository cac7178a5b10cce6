"""Structured Streaming: incremental star maintenance as batches arrive."""
