"""Registered queries: every operator run over the given tables, with the SQL to check it."""
