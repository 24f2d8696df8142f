"""Layered flight-delay analytics on Spark DataFrames and Structured Streaming."""
