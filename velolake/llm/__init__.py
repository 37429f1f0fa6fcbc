"""Operators of the training-data pipeline (one module per operator)."""
