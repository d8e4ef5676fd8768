"""Triggered and continuous runs of the sync and ingest steps."""
