"""Trade-stream analytics as plain PySpark DataFrame transformations."""
