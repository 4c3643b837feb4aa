"""Scans of landed snapshots. Nothing here opens a network connection."""
