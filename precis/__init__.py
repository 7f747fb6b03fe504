"""Text preparation, summarization and summary evaluation as Spark DataFrame jobs."""
