"""Scans, point stores, run progress and the mapping of the driver tables."""
