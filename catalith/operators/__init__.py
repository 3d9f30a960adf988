"""Operators: ``DataFrame -> DataFrame`` building blocks of catalog enrichment."""
