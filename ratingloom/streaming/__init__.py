"""Unbounded ratings: normalising the two formats, and starting the queries that write them."""
