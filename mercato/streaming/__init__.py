"""Continuous ingestion: topics to raw and curated layers, and live views of topics."""
