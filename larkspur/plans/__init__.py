"""Queries, and the catalogue of registered ones."""
