"""Operators for preparing training text and embeddings; nothing outside this folder imports them."""
