"""Landed files, Bronze log, layer tables."""
