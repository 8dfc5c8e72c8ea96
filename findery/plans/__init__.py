"""Index and search plans."""
