"""Independent SQL statements used to check the Spark results."""
