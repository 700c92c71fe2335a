"""Monthly sales, weather and sunshine analytics as Spark DataFrame plans."""
