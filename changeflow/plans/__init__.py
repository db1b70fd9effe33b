"""Registered queries over the test tables, each with an equivalent in plain SQL."""
