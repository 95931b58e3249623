"""Incremental export."""
