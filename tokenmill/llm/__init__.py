"""Filters, scans, dedup, decontamination, mixing and formatting of language-model training data."""
