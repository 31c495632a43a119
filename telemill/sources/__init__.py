"""Schemas, readers, writers and table maintenance."""
