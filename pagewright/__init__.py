"""Document-page pipelines on Spark."""
