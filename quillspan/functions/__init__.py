"""Scalar rules: word lists, thresholds and expressions over texts."""
