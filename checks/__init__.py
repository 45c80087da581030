"""Fixture views, registered queries and their independent SQL."""
