"""Social-activity analytics as plain Spark DataFrame jobs."""
