"""Thin sinks: snapshots with a pointer, partition replacement, bucketed tables, export parts and manifests."""
