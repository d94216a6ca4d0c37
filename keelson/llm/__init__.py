"""Operators for preparing training data at scale. Nothing else in the package imports them."""
