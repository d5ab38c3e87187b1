"""Training-data operators: near-dedup, substring dedup, extraction, secrets, quality, mixing, tokens, PII, fingerprints."""
