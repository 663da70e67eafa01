"""Period analysis on aggregated rows.

Windows without PARTITION BY (moving average, LAG over the whole series,
average of all periods) run on one row per period, so their input is
bounded by the calendar, not by the data.  Ranking inside a period is done
without a per-period window (``rank_desc``), and shares use a grouped total
or a scalar subquery instead of a window over everything.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import as_double, exact_ratio, pct_of, round_half_away


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def moving_average(value: str | Column, order: Sequence[str], rows: int = 3, places: int | None = 2,
                   partition: Sequence[str] = ()) -> Column:
    """AVG(value) OVER (ORDER BY order ROWS rows-1 PRECEDING .. CURRENT ROW).

    Summed exactly (a DECIMAL stays DECIMAL), divided once in DOUBLE."""
    v = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(order)).rowsBetween(-(rows - 1), 0)
    avg = as_double(F.sum(v).over(w)) / F.count(v).over(w)
    return avg if places is None else round_half_away(avg, places)


def previous(value: str, order: Sequence[str], partition: Sequence[str] = ()) -> Column:
    """LAG(value) over the period order (row-based: trap T10)."""
    return F.lag(F.col(value)).over(Window.partitionBy(*_cols(partition)).orderBy(*_cols(order)))


def growth_pct(current: str, prev: str, places: int = 2) -> Column:
    """ROUND((cur - prev) / NULLIF(prev, 0) * 100, 2); the difference is exact."""
    return exact_ratio(F.col(current) - F.col(prev), prev, places, factor=100)


def with_growth(df: DataFrame, value: str, order: Sequence[str], prev_out: str, growth_out: str,
                partition: Sequence[str] = ()) -> DataFrame:
    return (df.withColumn(prev_out, previous(value, order, partition))
              .withColumn(growth_out, growth_pct(value, prev_out)))


def running_total(value: str, partition: Sequence[str], order: Sequence[str]) -> Column:
    """SUM(value) OVER (PARTITION BY partition ORDER BY order) — the
    default RANGE frame, i.e. year-to-date when partitioned by year."""
    w = (Window.partitionBy(*_cols(partition)).orderBy(*_cols(order))
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(F.col(value)).over(w)


BROADCAST_ROWS = 5_000_000
WINDOW_ROWS = 100_000


def _maybe_broadcast(df: DataFrame, rows_bound: int | None) -> DataFrame:
    """Broadcast only under a proven row bound; otherwise leave it to AQE."""
    return F.broadcast(df) if rows_bound is not None and rows_bound <= BROADCAST_ROWS else df


STEPS = 1024      # value ranges per power of two
LOWEST = 1100     # 2^-1100 is below every positive DOUBLE
TOP_RANGE = 2 * LOWEST * STEPS + 1


def value_range(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises: the place of |v| on a
    logarithmic scale of ``STEPS`` ranges per power of two, with the sign of v.

    It is a function of the value alone, so every task, also a recomputed one,
    gives the same number and equal values always share it.  NULL, which a
    descending sort puts first, has the highest, NaN the next."""
    x = v.cast("double")
    place = F.floor((F.least(F.log2(F.abs(x)), F.lit(LOWEST - 1.0)) + LOWEST) * STEPS)
    return (F.when(x.isNull(), F.lit(TOP_RANGE)).when(F.isnan(x), F.lit(TOP_RANGE - 1)).when(x == 0, F.lit(0))
            .when(x > 0, place).otherwise(-place).cast("long"))


def rank_desc(df: DataFrame, partition: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """RANK() OVER (PARTITION BY partition ORDER BY value DESC), distributed.

    A per-period window would send a whole period to one task.  Instead the
    rows are collapsed to (period, value, count), so ties are one row however
    many they are.  The values are counted from above inside each
    ``value_range`` of a period, the rows of its higher ranges are added, and
    the ranks go back to the rows by (period, value).  Only the counts per
    range pass through a window per period, at most one row per range in use.
    NULL ranks before every value; NULL keys are a period like any other."""
    keys = list(partition)
    values = df.groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    values = values.withColumn("__range", value_range(F.col("__v")))

    def earlier(over: Sequence[str], order: Column) -> Column:
        w = Window.partitionBy(*over).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(w), F.lit(0))

    ranges = values.groupBy(*keys, "__range").agg(F.sum("__n").alias("__n"))
    ranges = ranges.select(*keys, "__range", earlier(keys, F.col("__range").desc()).alias("__higher"))
    inside = values.withColumn("__before", earlier([*keys, "__range"], F.col("__v").desc_nulls_first()))
    i, r = inside.alias("i"), ranges.alias("r")
    ranked = i.join(r, [F.col(f"i.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*keys, "__range"]]).select(
        *[F.col(f"i.{c}").alias(f"__k_{c}") for c in keys], "i.__v",
        (F.col("__before") + F.col("__higher") + F.lit(1)).cast("long").alias(out))
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys] + [F.col(value).eqNullSafe(F.col("__v"))]
    return df.join(ranked, on).select(*df.columns, out)


def share_of_total(df: DataFrame, value: str, out: str, places: int = 2,
                   partition: Sequence[str] = (), total_out: str | None = None,
                   groups_bound: int | None = None) -> DataFrame:
    """ROUND(100.0 * value / SUM(value) OVER (PARTITION BY ...), 2).

    Without a partition the grand total is a scalar subquery (computed once,
    shipped as a value), or a window over all rows where ``groups_bound`` proves
    them few, which reads the input once; with one, a grouped total joined back
    on the partition keys.  Neither sends unbounded rows to one task."""
    if not partition and groups_bound is not None and groups_bound <= WINDOW_ROWS:
        df = df.withColumn("__total", F.sum(value).over(Window.partitionBy()))
    elif not partition:
        total = df.agg(F.sum(value)).scalar()
        df = df.withColumn("__total", total)
    else:
        totals = df.groupBy(*partition).agg(F.sum(value).alias("__total"))
        df = df.join(_maybe_broadcast(totals, groups_bound), list(partition), "inner")
    df = df.withColumn(out, pct_of(F.col(value), F.col("__total"), places))
    if total_out:
        df = df.withColumnRenamed("__total", total_out)
    return df.drop("__total")


def ratio_to_mean(df: DataFrame, value: str, out: str, mean_out: str | None = None,
                  places: int = 4, mean_places: int = 2) -> DataFrame:
    """Value / AVG(value) over all rows (seasonality index), with the
    mean itself as a scalar subquery over the grouped rows."""
    mean = df.agg(as_double(F.sum(value)) / F.count(value)).scalar()
    df = df.withColumn(out, round_half_away(as_double(value) / F.nullif(mean, F.lit(0.0)), places))
    if mean_out:
        df = df.withColumn(mean_out, round_half_away(mean, mean_places))
    return df


def densify(df: DataFrame, periods: DataFrame, keys: Sequence[str], fill: Sequence[str],
            order_key: Column) -> DataFrame:
    """T10 dense mode: periods of the calendar inside the span of ``df`` that
    have no rows appear with 0 in ``fill`` columns, so LAG / moving averages
    step over calendar periods instead of present ones.  ``periods`` is the
    calendar (bounded), ``order_key`` a sortable expression over ``keys``."""
    lo = df.agg(F.min(order_key)).scalar()
    hi = df.agg(F.max(order_key)).scalar()
    span = periods.filter(order_key.between(lo, hi))
    out = span.join(df, list(keys), "left")
    return out.fillna(0, subset=list(fill))
