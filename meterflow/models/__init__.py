"""Model training, scoring and inspection with Spark ML."""
