"""Training-data operators over the corpus tables (documents, labels)."""
