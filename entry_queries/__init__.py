"""Registered queries over the given tables, each with SQL of its own to check it."""
