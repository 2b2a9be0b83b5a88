"""Modelled outputs (dimensions, fact, rollups, timeline) and the pipeline
that materialises them."""
