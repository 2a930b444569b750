"""DataFrame operators: quality gates, fill, enrichment, keys, warehouse, reports."""
