"""Composite queries: what a user runs."""
