"""Readers, raw intake, table sinks and registration."""
