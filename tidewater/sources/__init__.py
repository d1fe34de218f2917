"""Sources: table scans (window, snapshot, watermark, day slices, JDBC), NDJSON exports, declared-schema CSV batches, paged JSON."""
