"""Operators for training-data corpora; nothing else of the library imports them."""
