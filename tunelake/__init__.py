"""Listening-event analytics on Spark: raw files to bronze, silver, gold and serving views."""
