"""Transforms and aggregations over events, windows and rollups."""
