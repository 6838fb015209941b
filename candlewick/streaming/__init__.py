"""Structured Streaming jobs and what they carry between micro-batches."""
