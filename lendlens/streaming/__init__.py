"""Feedback ingestion for batch DataFrames and Structured Streaming."""
