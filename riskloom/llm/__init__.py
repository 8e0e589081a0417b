"""Operators of a training-data pipeline: filters, models, searches and duplicates.

Nothing else in the library imports this package.
"""
