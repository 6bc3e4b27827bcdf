"""Streaming entry points (see ``snapshots``)."""
