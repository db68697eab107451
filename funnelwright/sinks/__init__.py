"""Writing the stored tables."""
