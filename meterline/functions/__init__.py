"""Scalar column expressions and duration helpers."""
