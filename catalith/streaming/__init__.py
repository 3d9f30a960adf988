"""Streaming enrichment: pins arrive as files, payload metrics are looked up per batch and upserted."""
