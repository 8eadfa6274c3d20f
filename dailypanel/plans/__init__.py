"""Whole chains from readings to a model-ready panel, and the jobs on top of it."""
