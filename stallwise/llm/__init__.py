"""Operators for training data: duplicates, filters, tokens, extraction. Nothing else in the package imports this."""
