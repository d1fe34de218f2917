"""DataFrame -> DataFrame operators: filters, joins, projections, keep-latest, MERGE family, replacement, schema evolution, NPS rows, chunking."""
