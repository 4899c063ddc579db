"""Readers: landed files to typed DataFrames, with rejected rows kept."""
