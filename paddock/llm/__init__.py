"""Operators of a training-data pipeline over large text and vector tables."""
