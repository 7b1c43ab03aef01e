"""Operators for training-data pipelines over web archives, documents and embeddings."""
