"""Operators and one pipeline for preparing language-model training data."""
