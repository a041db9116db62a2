"""Whole jobs: nightly summaries, analyses, reports, the warehouse catalog."""
