"""Column helpers; everything here stays inside JVM expressions."""
