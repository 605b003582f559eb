"""Operators for building training data from text, vectors and pages."""
