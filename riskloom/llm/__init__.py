"""Operators for training-data pipelines and the numbered queries over them. Nothing else in the library imports this package."""
