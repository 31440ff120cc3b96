"""Operators for cleaning and preparing training text. Nothing else in the package imports this."""
