"""Readers for text, delimited and CSV files, and staging of shared results."""
