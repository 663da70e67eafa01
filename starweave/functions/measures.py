"""Measures of the sales fact as two-phase aggregates.

Each measure is a list of *parts* computed at a base grain and a *final*
aggregate over those parts.  The base grain is either the fact line itself
(every dimension broadcast) or a pre-aggregate of the fact by foreign keys
(a dimension too large to broadcast is joined after the fact has been
reduced).  The final expression is the same in both cases, so operators
never need to know which base they got.

Money is summed exactly as DECIMAL; ratios of sums and counts are rounded half
away from zero on whole numbers (``exact_ratio``).  Means of values that are
ratios themselves are taken and rounded in DOUBLE (``round_half_away``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM, MIN, MAX, KEY = "sum", "min", "max", "key"


@dataclass(frozen=True)
class Part:
    alias: str                      # column name at the base grain
    line: Callable[[], Column]      # value at fact-line grain
    kind: str                       # SUM / MIN / MAX: pre-aggregated; KEY: kept as grouping column
    source: str | None = None       # column read at line grain (fact or dimension attribute)


@dataclass(frozen=True)
class Measure:
    name: str
    parts: tuple[Part, ...]
    final: Callable[[Column | None], Column] = field(repr=False)
    """final(cond) -> aggregate over part columns; cond restricts the rows
    (conditional SUM / COUNT DISTINCT of the pivot operator)."""

    def agg(self, cond: Column | None = None, alias: str | None = None) -> Column:
        return self.final(cond).alias(alias or self.name)


def _sum_measure(name: str, line_col: str) -> Measure:
    alias = f"{name}__s"

    def final(cond):
        c = F.col(alias)
        return F.sum(c if cond is None else F.when(cond, c).otherwise(F.lit(0)))

    return Measure(name, (Part(alias, lambda: F.col(line_col), SUM, line_col),), final)


def _distinct_measure(name: str, key_col: str) -> Measure:
    def final(cond):
        c = F.col(key_col)
        return F.count_distinct(c if cond is None else F.when(cond, c))

    return Measure(name, (Part(key_col, lambda: F.col(key_col), KEY, key_col),), final)


def _approx_distinct_measure(name: str, key_col: str, rsd: float = 0.01) -> Measure:
    """Opt-in approximate distinct count (HyperLogLog++): the shuffle then
    carries one sketch per group instead of one row per (group, key)."""
    def final(cond):
        c = F.col(key_col)
        return F.approx_count_distinct(c if cond is None else F.when(cond, c), rsd)

    return Measure(name, (Part(key_col, lambda: F.col(key_col), KEY, key_col),), final)


TRX_COUNT = "trx__n"


def counted_trx() -> Measure:
    """``trx`` over rows that carry the number of their transactions."""
    def final(cond):
        n = F.col(TRX_COUNT)
        return F.coalesce(F.sum(n if cond is None else F.when(cond, n)), F.lit(0).cast("long"))

    return Measure("trx", (), final)


def _count_measure(name: str) -> Measure:
    alias = f"{name}__c"

    def final(cond):
        c = F.col(alias)
        return F.sum(c if cond is None else F.when(cond, c).otherwise(F.lit(0)))

    return Measure(name, (Part(alias, lambda: F.lit(1).cast("long"), SUM),), final)


def _min_measure(name: str, line_col: str) -> Measure:
    alias = f"{name}__m"
    return Measure(name, (Part(alias, lambda: F.col(line_col), MIN, line_col),),
                   lambda cond: F.min(F.col(alias) if cond is None else F.when(cond, F.col(alias))))


# The additive and distinct measures of the fact (rev, prof, qty, trx, ...).
MEASURES: dict[str, Measure] = {m.name: m for m in (
    _sum_measure("qty", "quantity_sold"),
    _sum_measure("revenue", "final_sales"),
    _sum_measure("profit", "gross_profit"),
    _sum_measure("cost", "cost_amount"),
    _sum_measure("discount", "discount_amount"),
    _sum_measure("gross_sales", "total_sales"),
    _count_measure("lines"),
    _distinct_measure("trx", "transaction_id"),
    _approx_distinct_measure("trx_approx", "transaction_id"),
    _distinct_measure("customers", "customer_key"),
    _distinct_measure("days", "full_date"),
    _min_measure("first_date", "full_date"),
)}


# Approximate twins of the distinct counts, same output names (SURVEY A3:
# an opt-in switch; exact stays the default).
APPROX: dict[str, Measure] = {name: _approx_distinct_measure(name, key) for name, key in (
    ("trx", "transaction_id"), ("customers", "customer_key"), ("days", "full_date"))}


def measure(name: str, approx_distinct: bool = False) -> Measure:
    if approx_distinct and name in APPROX:
        return APPROX[name]
    try:
        return MEASURES[name]
    except KeyError:
        raise KeyError(f"unknown measure {name!r}; known: {sorted(MEASURES)}") from None


# ----------------------------------------------------------------- ratios
def as_double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def round_half_away(x: Column, places: int) -> Column:
    """ROUND(x, places), half away from zero, on a DOUBLE.

    Written out so that every engine evaluating it gives the same bits."""
    scale = 10 ** places
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / F.lit(scale)


def _cents(c) -> Column:
    """A DECIMAL(.., 2) amount or a count as an exact whole number of 1/100."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("decimal(24,2)") * F.lit(100)).cast("decimal(26,0)")


def exact_ratio(num, den, places: int = 2, factor: int = 1) -> Column:
    """ROUND(factor * num / NULLIF(den, 0), places), half away from zero,
    decided on whole numbers: floor((2 |n| f 10^places + |d|) / (2 |d|)).

    Exact while |num| and |den| stay below 10^22 and the rounded quotient
    times 10^places below 9.2 * 10^18; beyond that ANSI mode raises."""
    n, d = _cents(num), _cents(den)
    doubled = F.lit(2 * factor * 10 ** places).cast("decimal(9,0)")
    whole = F.call_function("div", F.abs(n) * doubled + F.abs(d), F.nullif(F.abs(d) * F.lit(2), F.lit(0)))
    return F.signum(n) * F.signum(d) * whole.cast("double") / F.lit(float(10 ** places)) + F.lit(0.0)


def margin_pct(profit="profit", revenue="revenue", places: int = 2) -> Column:
    """ROUND(profit / NULLIF(revenue, 0) * 100, 2)."""
    return exact_ratio(profit, revenue, places, factor=100)


def ratio(num="revenue", den="discount", places: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), places): ROI and per-day averages."""
    return exact_ratio(num, den, places)


def avg_line_value(revenue="revenue", lines="lines", places: int = 2) -> Column:
    """ROUND(AVG(final_sales), 2): the mean per fact line (named
    "avg per transaction" in the reference, see SURVEY T6)."""
    return exact_ratio(revenue, lines, places)


def avg_transaction_value(revenue="revenue", trx="trx", places: int = 2) -> Column:
    """The true mean per transaction, revenue / COUNT(DISTINCT transaction_id)
    (T6: the reference's "avg per transaction" is a per-line mean)."""
    return exact_ratio(revenue, trx, places)


def pct_of(part: Column, whole: Column, places: int = 2) -> Column:
    """ROUND(100.0 * part / NULLIF(whole, 0), places)."""
    return exact_ratio(part, whole, places, factor=100)
