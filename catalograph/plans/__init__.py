"""Whole jobs built from the operators."""

from catalograph.plans.cleaning import Catalog, IncompleteArchives, clean, clean_by_first, read_catalog
from catalograph.plans.monthly import Expectations, catalog_checks, run_month

__all__ = ["Catalog", "Expectations", "IncompleteArchives", "catalog_checks", "clean", "clean_by_first", "read_catalog", "run_month"]
