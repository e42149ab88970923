"""Operators of a training-data pipeline: text formatting, filters, fingerprints, mixing, token files."""
