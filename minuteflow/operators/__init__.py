"""Batch operators over message DataFrames."""
