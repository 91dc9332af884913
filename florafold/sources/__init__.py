"""Scans, inventories, catalogues, sinks and archives."""
