"""Transaction-risk features, checks and reports as Spark DataFrame functions."""
