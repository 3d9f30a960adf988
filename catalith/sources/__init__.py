"""Readers and writers: CSV, row envelopes, payload tables, registry and tier maps."""
