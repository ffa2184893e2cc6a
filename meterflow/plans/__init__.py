"""Whole jobs chaining sources, operators and models."""
