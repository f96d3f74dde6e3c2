"""Operators for preparing large bodies of training text. Nothing else in the library imports this package."""
