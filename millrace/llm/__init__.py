"""Operators a training-data pipeline needs.  Nothing outside this package imports them."""
