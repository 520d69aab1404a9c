"""Composable DataFrame operators for ratings, reviews and orders.

Every operator takes DataFrames and returns a lazy DataFrame built from
built-in Spark functions. Nothing here collects rows to the driver.
"""
