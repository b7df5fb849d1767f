"""Scans: landed files or payload columns in, raw-shape DataFrames out."""
