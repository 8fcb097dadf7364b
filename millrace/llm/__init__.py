"""Operators for training-data texts; nothing else in the library imports this subpackage."""
