"""Operators for preparing training data: packing, extraction, scans, rules, models and deduplication."""
