"""Inventory analytics as plain Spark DataFrame functions.

``sources`` read and write tables, ``operators`` are the reusable DataFrame steps,
``functions`` are Column helpers, ``plans`` put them together (marts, forecast,
report, loader) and ``streaming`` runs the loader on a file stream.
"""
