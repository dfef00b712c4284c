"""Registered queries over the driver tables, each with the SQL that must agree with it."""
