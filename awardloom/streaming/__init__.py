"""Incremental intake of landed files, each file exactly once."""
