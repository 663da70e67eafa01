"""Operators over a ``Star``: OLAP (C1-C7), period analysis (W1-W10),
data-quality audits (Q1-Q12) and the SCD2 merge (S12)."""
