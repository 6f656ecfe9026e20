"""Document and retrieval analytics as Spark jobs."""
