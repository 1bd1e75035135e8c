"""Market-data analytics as Spark DataFrame operators and repeatable jobs."""
