"""Queries over the driver tables, by group, each with its SQL."""
