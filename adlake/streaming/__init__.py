"""Structured Streaming jobs sharing the batch transformations."""
