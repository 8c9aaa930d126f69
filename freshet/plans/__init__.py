"""Published datasets, composed from the operators."""
