"""Readers and ingestion."""
