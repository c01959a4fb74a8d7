"""Operators for corpora that language models are trained on. Nothing else in the library imports this package."""
