"""Incremental runs and the watch over their results."""
