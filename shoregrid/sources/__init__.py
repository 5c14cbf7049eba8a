"""Readers: files and stored documents to DataFrames with declared schemas."""
