"""Periodic refresh of the unified table."""
