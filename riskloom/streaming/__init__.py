"""Incremental and continuous processing of append-only logs."""
