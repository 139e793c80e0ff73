"""Queries over the driver's tables, each with the SQL that states its expected result."""

from __future__ import annotations

from importlib import import_module

from gridmart.catalogue.common import CATALOGUE, Catalogue

MODULES = ("scans", "scalars", "versions", "quality", "models", "reports", "streams")


def load_catalogue() -> Catalogue:
    """The catalogue with the queries of all modules registered."""
    for module in MODULES:
        import_module(f"gridmart.catalogue.{module}")
    return CATALOGUE
