"""Structured Streaming jobs: landing to bronze, bronze to silver."""
