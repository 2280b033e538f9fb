"""Whole jobs composed of the operators: weather, stock prices, text classification."""
