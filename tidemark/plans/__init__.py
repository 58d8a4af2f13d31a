"""Whole jobs made of operators, and the views and queries that exercise each operator."""
