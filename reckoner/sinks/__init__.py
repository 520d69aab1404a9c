"""Text renderings of results, and writers."""
