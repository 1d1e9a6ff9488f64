"""Catalogue-shaped tables derived from the plain test tables, for queries and tests."""
