"""Relational and statistical operators of the panel workflow."""
