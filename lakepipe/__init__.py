"""Layered lakehouse analytics for card-style transactions, as PySpark DataFrame functions."""
