"""Training-data operators: mixing, dedup, filters, fingerprints, scoring, tokenising, extraction."""
