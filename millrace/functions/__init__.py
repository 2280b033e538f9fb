"""Column functions: scalars, text and user-defined functions."""
