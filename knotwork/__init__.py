"""Record linkage and text analytics as composable Spark DataFrame transformations."""
