"""Operators of a training-data pipeline over document, page and benchmark tables."""
