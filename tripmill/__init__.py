"""Trip-duration data preparation, scoring and event ingest on Spark."""
