"""Marketing, billing and product-usage analytics as Spark DataFrame jobs."""
