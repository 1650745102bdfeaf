"""Scalar functions over Columns."""
