"""Readers: files, text records and catalogs to DataFrames."""
