"""Readers and writers for documents, manifests, seeds and tables."""
