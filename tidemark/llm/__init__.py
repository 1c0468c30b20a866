"""Operators for preparing training text and vectors, and the queries that apply them."""
