"""Queries over the given tables, each with an equivalent ANSI SQL text where one is practical."""

from catalith.workload.registry import ORACLES, QUERIES


def load() -> None:
    """Import every query module, which fills the two tables above."""
    from catalith.workload import artifacts, companies, enrichment, extraction, imports, joins, matching, metrics, quality, schema, scores, series, streams, texts, votes  # noqa: F401


__all__ = ["ORACLES", "QUERIES", "load"]
