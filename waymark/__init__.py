"""Route-quality analytics as Spark DataFrame plans."""
