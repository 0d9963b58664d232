"""Operators for training data: survivors of duplicates, evaluation leaks, source mixing and abusive content."""
