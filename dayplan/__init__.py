"""Daily commute plans for a synthetic population, as Spark DataFrame jobs."""
