"""Lake-water analytics on Spark: swath pixels to lake tables, as DataFrame and SQL jobs."""
