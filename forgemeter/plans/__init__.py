"""Analytical tables, their data tests, and the two end-to-end runs."""
