"""Whole jobs: the batch reports, the live queries and the serving views."""
