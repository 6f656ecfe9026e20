"""Queries over the shared tables, with the SQL that says the same."""
