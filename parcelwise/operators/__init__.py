"""Grain control, delivery arithmetic, dimensions, facts and distributed ranking."""
