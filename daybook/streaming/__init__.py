"""Micro-batch execution of the pipeline with Structured Streaming."""
