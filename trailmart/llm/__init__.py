"""Operators on documents and web pages for building training data."""
