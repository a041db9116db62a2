"""Commerce analytics on Spark: streaming layers, nightly summaries, reports."""
