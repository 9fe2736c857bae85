"""DataFrame steps: population filters, enrichment joins, skew handling, ordered rules."""
