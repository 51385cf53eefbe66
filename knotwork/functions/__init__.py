"""Column functions of the normalisation layer."""
