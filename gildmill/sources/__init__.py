"""Readers, writers and the batch document sink."""
