"""Snapline: monitoring snapshots assembled and analysed with Spark DataFrames."""
