"""Whole flows and the query catalogue built from the operators."""
