"""Operators of a training-data pipeline: one module for each, and the queries that run them."""
