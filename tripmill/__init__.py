"""Trip analytics on Spark: typed loads, star schema, revenue reports, merges, streams."""
