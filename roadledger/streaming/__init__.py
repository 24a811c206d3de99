"""Incremental intake of new export files."""
