"""Readers: landed snapshots, lake tables, the line catalogue and report files."""
