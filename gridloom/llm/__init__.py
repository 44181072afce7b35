"""Operators that prepare text, vectors and conversations for model training."""
