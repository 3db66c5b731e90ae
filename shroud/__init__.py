"""Privacy jobs over Spark tables and streams."""
