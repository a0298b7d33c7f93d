"""parcelle: housing-market analytics as Spark DataFrame jobs."""
