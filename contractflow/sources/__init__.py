"""Readers for landing files, documents and stored tables."""
