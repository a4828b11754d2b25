"""Reading landed files, normalising them, and writing lake tables."""
