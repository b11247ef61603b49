"""End-to-end compositions and the query catalogue."""
