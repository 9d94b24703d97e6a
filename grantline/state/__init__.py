"""State on plain files: an append-only journal and the views on it."""
