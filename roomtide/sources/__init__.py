"""Readers, writers, fingerprints and the booking views over the star schema."""
