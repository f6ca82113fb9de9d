"""Operators on corpora, pages and embeddings for training-data work."""
