"""Operators on text and records that prepare training data for language models."""
