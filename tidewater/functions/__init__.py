"""Scalar helpers (time, text, sequence neighbours)."""
