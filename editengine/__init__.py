"""Batch and streaming analytics over page-edit events, on Spark DataFrames."""
