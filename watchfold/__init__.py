"""Security log and network-traffic analytics as Spark DataFrame transformations."""
