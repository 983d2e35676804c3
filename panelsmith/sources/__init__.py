"""Landed sources: readers, writers, dimensions and per-source normalisers."""
