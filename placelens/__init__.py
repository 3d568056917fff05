"""Placement analytics on Spark: validity intervals, log attribution, score enrichment, token streams."""
