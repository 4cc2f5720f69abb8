"""Whole runs, views for consumers, and the query catalogue."""
