"""Operators for training-data corpora: packing, fixity, mixing, fingerprints, quality, tokens, HTML, near-duplicates."""
