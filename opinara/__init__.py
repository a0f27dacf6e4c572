"""Voice-of-customer analytics as Spark DataFrame transformations."""
