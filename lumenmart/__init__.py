"""Product-analytics warehouse built from Spark DataFrame jobs."""
