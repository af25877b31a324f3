"""Readers for the raw landing zone and the layer tables."""
