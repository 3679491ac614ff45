"""Daily equity analytics as Spark DataFrame transformations."""
