"""Readers, writers, schemas and the durable scratch folder."""
