"""Relational operators of the pipeline, each a DataFrame -> DataFrame function."""
