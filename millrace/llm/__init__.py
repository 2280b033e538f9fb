"""Operators for the preparation of training text."""
