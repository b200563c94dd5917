"""Composite dataflows."""
