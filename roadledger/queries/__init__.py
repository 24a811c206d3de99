"""Queries over the sample tables and the independent SQL they must agree with."""
