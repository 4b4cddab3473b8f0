"""Training-data operators: fingerprints, language ID, search, packing, scoring, tokens, dedup."""
