"""Readers, writers, upserts and clustered layouts."""
