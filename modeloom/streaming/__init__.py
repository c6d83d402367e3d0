"""Stateless encoding of streaming DataFrames."""
