"""mendflow: a dead-letter loop for bad data, written as Spark DataFrame operators."""
