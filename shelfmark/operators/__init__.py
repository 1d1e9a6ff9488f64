"""Relational operators shared by the rules and jobs."""
