"""Reusable DataFrame-in, DataFrame-out steps."""
