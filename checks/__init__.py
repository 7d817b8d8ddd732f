"""SQL the queries are compared with, and the comparison."""
