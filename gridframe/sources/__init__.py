"""Saved sheet content in and out: values bodies, row metadata, stored grids."""
