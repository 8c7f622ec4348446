"""Whole jobs: the refresh of a warehouse, and the registered queries with their SQL."""
