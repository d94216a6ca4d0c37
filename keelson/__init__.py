"""Batch operators for building a historised customer dimension on Spark."""
