"""Incremental refresh of the batch stages."""
