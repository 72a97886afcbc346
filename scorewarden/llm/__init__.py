"""Operators of a training-data pipeline: mixing, filtering, scans, deduplication, scoring, decontamination."""
