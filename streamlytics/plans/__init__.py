"""Registered queries: each one an operator on the given tables plus the SQL it must equal."""
