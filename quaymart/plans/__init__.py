"""Complete results built from the operators."""
