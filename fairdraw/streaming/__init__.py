"""Sampling of streams."""
