"""Whole jobs built from the operators: import, resolve, enrich, export, sync, validate, review, tiers, registry check."""

from catalith.plans.enrich import enrich, enrich_provider
from catalith.plans.imports import import_catalog, match_pins, normalize_catalog
from catalith.plans.repair import resolve_pins

__all__ = ["enrich", "enrich_provider", "import_catalog", "match_pins", "normalize_catalog", "resolve_pins"]
