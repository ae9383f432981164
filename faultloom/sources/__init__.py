"""Readers and writers: landed payloads, snapshots, cursors, outside records."""
