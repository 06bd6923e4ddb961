"""Operators for preparing training text, over tables of documents, pages and embeddings."""
