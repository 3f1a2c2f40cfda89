"""Contract runs and the gold products."""
