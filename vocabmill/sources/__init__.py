"""Readers and writers of the source formats."""
