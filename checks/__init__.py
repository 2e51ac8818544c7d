"""Registered queries and, for each, the SQL it must agree with."""
