"""Operators for preparing language-model training data. Nothing else here imports this."""
