"""Whole flows and the registry of checked queries."""
