"""Command lines for spark-submit."""
