"""Incremental driver for the batch release plan (no extra operators)."""
