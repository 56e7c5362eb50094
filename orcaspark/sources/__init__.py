"""Readers: tables, lookup files, key maps, snapshots."""
