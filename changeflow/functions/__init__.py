"""Scalar functions as Column expressions: quoting, defaults, hashing, naming."""
