"""Operators over text corpora. Nothing else in the library imports this package."""
