"""Operators of a training-data pipeline (see the README's table for the methods)."""
