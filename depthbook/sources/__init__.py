"""Readers and writers for feed pages, snapshots and reference data."""
