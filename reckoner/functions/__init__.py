"""Column expressions: text, numbers, buckets and dates."""
