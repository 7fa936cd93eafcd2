"""Readers and writers; schemas are explicit, never inferred."""
