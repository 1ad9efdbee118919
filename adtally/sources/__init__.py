"""Readers for logs, dimensions, partner files and contract feeds."""
