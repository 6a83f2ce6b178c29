"""Learning-resource recommendation analytics as Spark DataFrame jobs."""
