"""Operators for preparing training data from a table of documents, as Spark jobs."""
