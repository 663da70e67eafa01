"""Derived labels: age bands (P5), subtotal labels (P9), report types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four customer age bands and their upper bounds
# (age < 26, < 40, < 55, otherwise), as labelled in the reference.
AGE_BANDS = (
    (26, "Youth (< 26)"),
    (40, "Adult (26-39)"),
    (55, "Middle (40-54)"),
)
AGE_BAND_LAST = "Senior (55+)"


def age_group(age: Column) -> Column:
    """P5. A NULL age falls through to the last band, as in the reference."""
    expr = None
    for bound, label in AGE_BANDS:
        expr = (F.when(age < bound, F.lit(label)) if expr is None
                else expr.when(age < bound, F.lit(label)))
    return expr.otherwise(F.lit(AGE_BAND_LAST))


def subtotal_label(col: str, label: str) -> Column:
    """P9 with trap T5 fixed: the label comes from GROUPING(), so a real NULL
    attribute value stays NULL instead of being shown as a subtotal."""
    return F.when(F.grouping(col) == 1, F.lit(label)).otherwise(F.col(col).cast("string"))


def weekend_label(is_weekend: Column) -> Column:
    """P8: 'Weekend' / 'Weekday'."""
    return F.when(is_weekend, F.lit("Weekend")).otherwise(F.lit("Weekday"))
