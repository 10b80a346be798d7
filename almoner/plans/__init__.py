"""Whole jobs, and the queries registered for the test tables."""
