"""Registered queries: the operators applied to the driver tables, each with SQL to check it."""
