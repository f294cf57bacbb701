"""Structured Streaming faces of the run ledger."""
