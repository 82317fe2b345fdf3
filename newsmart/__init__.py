"""News-archive analytics as Spark DataFrame plans."""
