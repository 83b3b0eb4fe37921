"""Relational, warehouse, quality, change and feature operators; DataFrames in, DataFrames out."""
