"""Batch operators, DataFrame in and DataFrame out."""
