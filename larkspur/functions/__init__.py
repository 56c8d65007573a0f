"""Expressions and how they become Spark columns."""
