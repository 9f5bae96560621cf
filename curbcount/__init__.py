"""Traffic-volume analytics and forecasting as plain Spark jobs."""
