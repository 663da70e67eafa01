"""Operators of a training-data pipeline: web archives, URL lists, packing,
near duplicates, fingerprints, repeated passages, nearest neighbours,
toxicity, personal data and subword encoding.  Nothing else in the library
imports this subpackage."""
