"""Readers. Each returns a DataFrame, or a small description of files."""
