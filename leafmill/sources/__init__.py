"""Readers of snapshots of the web."""
