"""Schemas, readers, writers and the fleet view over the delivered tables."""
