"""Customer-retention, retrieval and campaign analytics as Spark DataFrame operators."""
