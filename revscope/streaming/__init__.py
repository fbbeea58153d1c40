"""Structured Streaming forms of the feature tables."""
