"""Structured Streaming form of the loader."""
