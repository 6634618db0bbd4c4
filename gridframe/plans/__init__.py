"""Whole pipelines: read a sheet, refresh a sheet."""
