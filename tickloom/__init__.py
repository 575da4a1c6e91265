"""Market-microstructure analytics as Spark DataFrame operators."""
