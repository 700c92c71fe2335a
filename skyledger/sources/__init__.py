"""Readers of raw files: preamble text and cell grids."""
