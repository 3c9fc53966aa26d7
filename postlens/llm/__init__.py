"""Operators of a training-data pipeline over ``documents``, ``embeddings``, ``benchmark`` and ``labels``."""
