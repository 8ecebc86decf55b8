"""Queries over the given tables with the SQL that says what they must return."""
