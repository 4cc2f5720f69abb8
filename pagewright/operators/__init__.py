"""Relational and imaging operators."""
