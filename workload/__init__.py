"""Registered queries: each operator over the given tables, with the SQL it must agree with."""
