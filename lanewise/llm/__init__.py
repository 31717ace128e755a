"""Operators for building training data from text, conversations and vectors."""
