"""Readers: trip months, stored documents, stream records, and views over the test tables."""
