"""Readers, writers, catalog and audit tables."""
