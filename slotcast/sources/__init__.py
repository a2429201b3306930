"""Readers, writers and the adaptors from the shared test tables."""
