"""Composite analyses: the public entry points."""
