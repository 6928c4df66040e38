"""Citation-graph extraction, inversion and validation expressed as Spark jobs."""
