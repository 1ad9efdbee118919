"""Relational operators the reports are composed of."""
