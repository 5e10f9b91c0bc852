"""Operators over variant tables and file manifests: DataFrames in, DataFrames out."""
