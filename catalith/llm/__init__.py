"""Operators for texts and duplicates in training data. Nothing else in the library imports this package."""
