"""Operators for training data: fingerprints, dedup, filters, mixing, tokens. Nothing else imports this package."""
