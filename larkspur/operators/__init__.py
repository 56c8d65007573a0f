"""Relational steps over DataFrames whose rows have an order."""
