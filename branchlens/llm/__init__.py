"""Training-data operators (see the README section of the same name)."""
