"""Readers of raw pairs, records, manifests and file listings."""
