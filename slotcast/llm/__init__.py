"""Operators for large text corpora: tokens, duplicates, extraction, filters, scores and nearest neighbours."""
