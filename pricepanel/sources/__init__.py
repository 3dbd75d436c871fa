"""Readers, writers and the adapters from the star-schema tables to price panels."""
