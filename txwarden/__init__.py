"""Transaction scoring and monitoring as Spark jobs."""
