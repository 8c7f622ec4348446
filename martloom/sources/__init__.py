"""Readers: document collections, the stored tables, and collections derived from sample tables."""
