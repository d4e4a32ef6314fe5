"""Operators for training data: text, labels and conversations in, documents and digests out."""
