"""Readers and writers for tables, documents and objects."""
