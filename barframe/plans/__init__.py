"""Operators chained into the jobs a user runs."""
