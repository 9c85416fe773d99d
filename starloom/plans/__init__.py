"""Runs over a warehouse: storage/manifest, loads, validation, query catalog."""
