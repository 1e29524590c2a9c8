"""Whole jobs: history, batch, publish, validation."""
