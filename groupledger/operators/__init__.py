"""Relational operators the plans are composed of."""
