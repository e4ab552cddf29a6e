"""Whole jobs put together from the operators, and the catalog of runnable queries."""
