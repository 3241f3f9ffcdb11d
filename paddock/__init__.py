"""Paddock: listing-price analytics on Spark DataFrames."""
