"""Composite transforms: each is one user-level function over frames."""
