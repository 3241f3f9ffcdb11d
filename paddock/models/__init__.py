"""Price models on Spark MLlib and their feature frames."""
