"""Stock carried from movement to movement (the rule of audit Q8 as a chain).

A stock never falls below zero: after each movement it is
``max(0, stock before + in - out)``.  Unrolled, that is the prefix sum of the
movements less its running minimum (where that is below zero), so no step has
to wait for the one before it.  Prefix sums and minima are taken inside short
stretches of time first; a stretch is then one row of (sum, least prefix), and
the rows of a chain are folded in time order.  A chain with a third of all
movements is spread over its stretches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MADE = ("beginning_stock", "ending_stock")


def running_stock(moves: DataFrame, keys: Sequence[str], stretch: str, order: Sequence[str], opening: int = 0) -> DataFrame:
    """``moves`` (stock_in, stock_out) with beginning_stock and ending_stock.

    Movements of equal ``keys`` are a chain; ``stretch`` is a column that never
    falls along ``order`` (a date or hour of the movement), and ``order`` is
    unique within a chain.  Null keys form a chain of their own, a null
    quantity counts as 0, columns named like the results are replaced.
    """
    if opening < 0:
        raise ValueError("a chain cannot open below zero")
    moves = moves.drop(*MADE)
    quantity = F.coalesce("stock_in", F.lit(0)).cast("long") - F.coalesce("stock_out", F.lit(0)).cast("long")
    inside = Window.partitionBy(*keys, stretch).orderBy(*order)
    here, before = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    rows = moves.withColumn("__move", quantity).withColumn("__sum", F.sum("__move").over(here))
    rows = rows.withColumns({"__least": F.min("__sum").over(here), "__least_before": F.min("__sum").over(before)})

    folded = rows.groupBy(*keys, stretch).agg(F.sum("__move").alias("total"), F.min("__sum").alias("least"))
    earlier = Window.partitionBy(*keys).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    folded = folded.withColumn("base", F.lit(opening).cast("long") + F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    folded = folded.withColumn("floor", F.least(F.lit(0).cast("long"), F.min(F.col("base") + F.col("least")).over(earlier)))
    names = {k: f"__k{i}" for i, k in enumerate((*keys, stretch))}
    folded = folded.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("base").alias("__base"), F.col("floor").alias("__floor"))

    same = None
    for k, n in names.items():
        one = F.col(k).eqNullSafe(F.col(n))
        same = one if same is None else same & one
    held = F.col("__base") + F.col("__sum")
    out = rows.join(folded, same).withColumns({
        "beginning_stock": held - F.col("__move") - F.least(F.col("__floor"), F.col("__base") + F.col("__least_before")),
        "ending_stock": held - F.least(F.col("__floor"), F.col("__base") + F.col("__least"))})
    return out.select(*moves.columns, *MADE)
