"""Trip analytics on Spark: composable ``DataFrame -> DataFrame`` functions."""
