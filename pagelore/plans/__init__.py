"""Whole plans and the registry of queries."""
