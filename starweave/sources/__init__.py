"""Readers for the raw retail source tables and the TPC-H-style test tables."""
