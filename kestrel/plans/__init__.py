"""Compositions of operators: the mart pipeline and the query registry."""
