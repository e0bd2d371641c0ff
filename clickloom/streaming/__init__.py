"""Structured Streaming into the stores of the batch job."""
