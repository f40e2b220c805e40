"""Product and review intelligence as plain Spark jobs."""
