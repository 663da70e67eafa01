"""The star: seven dimensions around the transaction-line sales fact.

``Star.base`` is the one place where the fact meets its dimensions.  It
joins only the dimensions a query names, filters dimensions before the
join, turns time filters into a range on the smart ``time_key`` (parquet
min/max skipping and ``sale_year`` partition pruning), and chooses per
dimension between

* a broadcast hash join, when the dimension has a *proven* row bound
  (the calendar and the payment map by construction, the others from the
  row count recorded when the star was materialised), and
* a pre-aggregation of the fact by that dimension's key followed by a
  shuffle join, when the bound is unknown or too large: the shuffle then
  carries one row per key instead of one row per fact line, and a hot key
  (one product with a third of all sales) collapses to one row before the
  exchange.  With several large dimensions the fact is re-aggregated after
  each join (filtered and co-located dimensions first).

Distinct transactions are counted by key before a large dimension of the
transaction header (customer, store) is joined, so the transaction never
travels through that join; counts of different keys add.

``scope`` adds filters to every query, ``approx_distinct`` turns distinct
counts into HyperLogLog++ sketches, and ``join_mode`` forces one strategy
(tests use it to check both give the same answer).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import iso_year
from ..functions.measures import KEY, MAX, MIN, SUM, TRX_COUNT, Measure, counted_trx, measure

# dimension name -> (table name, surrogate key)
DIMENSIONS: dict[str, tuple[str, str]] = {
    "time": ("dim_time", "time_key"),
    "product": ("dim_product", "product_key"),
    "customer": ("dim_customer", "customer_key"),
    "store": ("dim_store", "store_key"),
    "supplier": ("dim_supplier", "supplier_key"),
    "promotion": ("dim_promotion", "promotion_key"),
    "payment": ("dim_payment_method", "payment_key"),
}

FACT_COLUMNS = ("time_key", "product_key", "customer_key", "store_key", "promotion_key",
                "supplier_key", "payment_key", "transaction_id", "detail_id", "quantity_sold",
                "unit_price", "discount_amount", "total_sales", "final_sales", "cost_amount",
                "gross_profit")

# Unqualified attribute names that exist in two dimensions resolve here.
PREFERRED = {"city": "store", "unit_price": "product"}

# Attributes computed from a dimension's columns when a query asks for them
# (the stored dimension keeps the reference's schema).
DERIVED: dict[str, tuple[str, Callable[[], Column]]] = {
    "iso_year": ("time", lambda: iso_year(F.col("full_date"))),
}

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20
FACT_PARTITION = "sale_year"


@dataclass(frozen=True)
class Attr:
    dim: str
    column: str
    out: str


@dataclass
class Star:
    fact: DataFrame
    dims: dict[str, DataFrame]
    bounds: dict[str, int | None] = field(default_factory=dict)
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS
    location: str | None = None
    join_mode: str | None = None   # None: per dimension; "broadcast" / "preagg": force one plan
    scope: dict = field(default_factory=dict)  # filters added to every query, e.g. {"year": 2025} (T12)
    colocated: str | None = None   # dimension bucketed together with the fact (joined first, no exchange)
    approx_distinct: bool = False  # distinct counts as HyperLogLog++ sketches (opt-in, A3)
    byte_bounds: dict[str, int | None] = field(default_factory=dict)  # observed upper bound of bytes
    # Dimensions single-valued per transaction (taken from the transaction
    # header by the builder): grouping only by them, a transaction falls in
    # one cell at every level, so COUNT(DISTINCT transaction_id) is a count.
    trx_level: frozenset = frozenset()
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES

    # ------------------------------------------------------------ access
    def table(self, name: str) -> DataFrame:
        if name == "fact_sales":
            return self.fact.select(*FACT_COLUMNS)
        for dim, (table, _) in DIMENSIONS.items():
            if name in (dim, table):
                return self.dims[dim]
        raise KeyError(name)

    def tables(self) -> dict[str, DataFrame]:
        out = {table: self.dims[d] for d, (table, _) in DIMENSIONS.items()}
        out["fact_sales"] = self.table("fact_sales")
        return out

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp views ``fact_sales``, ``dim_time``, ... so the star can be
        queried with ``spark.sql`` under the warehouse table names."""
        names = []
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def resolve(self, name: str) -> Attr:
        if "." in name:
            dim, col = name.split(".", 1)
            if dim not in DIMENSIONS or col not in self.dims[dim].columns:
                raise KeyError(name)
            return Attr(dim, col, f"{dim}_{col}" if col in PREFERRED else col)
        if name in PREFERRED:
            return Attr(PREFERRED[name], name, name)
        if name in DERIVED and name not in self.dims[DERIVED[name][0]].columns:
            return Attr(DERIVED[name][0], name, name)
        owners = [d for d in DIMENSIONS if name in self.dims[d].columns]
        if len(owners) != 1:
            raise KeyError(f"attribute {name!r} is {'ambiguous' if owners else 'unknown'}")
        return Attr(owners[0], name, name)

    def broadcastable(self, dim: str) -> bool:
        """Proven small: a row bound under the limit and, when the star was
        written, an observed byte size under the budget too."""
        b = self.bounds.get(dim)
        size = self.byte_bounds.get(dim)
        return (b is not None and b <= self.broadcast_rows
                and (size is None or size <= self.broadcast_bytes))

    # ------------------------------------------------------------ filters
    @staticmethod
    def _predicate(col: Column, value) -> Column:
        if isinstance(value, Column):
            return value
        if callable(value):
            return value(col)
        if isinstance(value, (list, tuple, set, frozenset)):
            return col.isin(list(value))
        return col == F.lit(value)

    def _time_range(self, where: Mapping) -> list[Column]:
        """Fact-side predicates implied by time filters (time_key = yyyymmdd)."""
        preds: list[Column] = []
        y = where.get("year")
        years = [y] if isinstance(y, int) else (list(y) if isinstance(y, (list, tuple)) else None)
        if years:
            if FACT_PARTITION in self.fact.columns:
                preds.append(F.col(FACT_PARTITION).isin(years))
            if len(years) == 1:
                lo, hi = years[0] * 10000 + 101, years[0] * 10000 + 1231
                m, q = where.get("month"), where.get("quarter")
                if isinstance(m, int):
                    lo, hi = years[0] * 10000 + m * 100 + 1, years[0] * 10000 + m * 100 + 31
                elif isinstance(q, int):
                    lo = years[0] * 10000 + (3 * q - 2) * 100 + 1
                    hi = years[0] * 10000 + (3 * q) * 100 + 31
                preds.append(F.col("time_key").between(lo, hi))
        return preds

    # ------------------------------------------------------------ base
    def counts_by_key(self, attrs: Iterable[str], measures: Iterable[Measure], where: Mapping | None = None,
                      force: str | None = None) -> bool:
        """Whether transactions can be counted by the keys of the large
        dimensions of a query, before these are joined: ``trx`` is its only
        distinct count and every large dimension comes from the transaction
        header, so the transactions of two keys are disjoint and their counts add."""
        force = force or self.join_mode
        parts = [p for m in measures for p in m.parts]
        if self.approx_distinct or [m.name for m in measures if any(p.kind == KEY for p in m.parts)] != ["trx"]:
            return False
        columns = [p.source for p in parts if p.source and p.source not in self.fact.columns]
        dims = {self.resolve(a).dim for a in (*attrs, *columns, *self.scope, *(where or {}))}
        large = {d for d in dims if force != "broadcast" and (force == "preagg" or not self.broadcastable(d))}
        return bool(large) and large <= set(self.trx_level)

    def counted_base(self, attrs: Iterable[str], measures: Iterable[Measure], where: Mapping | None = None,
                     force: str | None = None) -> tuple[DataFrame, list[Measure]]:
        """``base`` and the measures to take over it, with the transactions
        counted before the large dimensions are joined where that is exact for
        a grouping by all of ``attrs``."""
        attrs, measures = list(attrs), list(measures)
        if not self.counts_by_key(attrs, measures, where, force):
            return self.base(attrs, measures, where, force), measures
        return (self.base(attrs, measures, where, force, count_trx=True),
                [counted_trx() if m.name == "trx" else m for m in measures])

    def base(self, attrs: Iterable[str], measures: Iterable[str | Measure], where: Mapping | None = None,
             force: str | None = None, count_trx: bool = False, copies: Sequence[Sequence[str]] = ()) -> DataFrame:
        """The fact at the grain (attrs + distinct keys), with measure parts;
        with ``count_trx`` the number of transactions instead of their key.
        ``copies`` (lists of attributes of joined-small dimensions) counts once
        for each list, its number in ``__copy``, with the attributes of other
        lists null.

        ``force`` = "broadcast" | "preagg" overrides the per-dimension choice
        (tests use it to check both plans give the same answer)."""
        where = {**self.scope, **(where or {})}
        force = force or self.join_mode
        ms = [measure(m, self.approx_distinct) if isinstance(m, str) else m for m in measures]
        out_attrs = [self.resolve(a) for a in dict.fromkeys(attrs)]
        parts = list({p.alias: p for m in ms for p in m.parts}.values())

        # Which dimension supplies which column (attributes, filters, parts).
        need: dict[str, dict[str, str]] = {}          # dim -> {column: out name}
        for a in out_attrs:
            need.setdefault(a.dim, {})[a.column] = a.out
        filters: dict[str, list[Column]] = {}
        for name, value in where.items():
            a = self.resolve(name)
            need.setdefault(a.dim, {})
            derived = a.column in DERIVED and a.column not in self.dims[a.dim].columns
            col = DERIVED[a.column][1]() if derived else F.col(a.column)
            filters.setdefault(a.dim, []).append(self._predicate(col, value))
        line_parts: dict[str, Column] = {}
        fact_cols = set(self.fact.columns)
        for p in parts:
            if p.source and p.source not in fact_cols:
                a = self.resolve(p.source)
                need.setdefault(a.dim, {})[a.column] = a.out
            if p.kind != KEY:
                line_parts[p.alias] = p.line()

        def dim_side(dim: str) -> DataFrame:
            key = DIMENSIONS[dim][1]
            d = self.dims[dim]
            for pred in filters.get(dim, []):
                d = d.filter(pred)
            def column(c):
                return DERIVED[c][1]() if c in DERIVED and c not in d.columns else F.col(c)
            cols = [F.col(key)] + [column(c).alias(o) for c, o in need[dim].items() if c != key]
            return d.select(*cols)

        if force == "broadcast":
            small = list(need)
        elif force == "preagg":
            small = []
        else:
            small = [d for d in need if self.broadcastable(d)]
        large = [d for d in need if d not in small]

        # a fact column that no measure reads must not meet a dimension's of the same name
        taken = {o for cols in need.values() for o in cols.values()}
        keep = {p.source for p in parts} | {k for _, k in DIMENSIONS.values()}
        f = self.fact.drop(*[c for c in fact_cols if c in taken and c not in keep])
        for pred in self._time_range(where):
            f = f.filter(pred)
        for d in small:
            f = f.join(F.broadcast(dim_side(d)), DIMENSIONS[d][1], "inner")

        if copies:
            f = f.withColumn("__copy", F.explode(F.array(*[F.lit(i) for i in range(len(copies))])))
            for out in sorted({c for one in copies for c in one}):
                holds = F.col("__copy").isin([i for i, one in enumerate(copies) if out in one])
                f = f.withColumn(out, F.when(holds, F.col(out)))
        key_parts = [p.alias for p in parts if p.kind == KEY]
        small_outs = [o for d in small for o in need[d].values()]
        if not large:
            cols = list(dict.fromkeys([a.out for a in out_attrs] + key_parts))
            return f.select(*[F.col(c) for c in cols],
                            *[c.alias(n) for n, c in line_parts.items()])

        # Pre-aggregate by (small attrs, large keys, distinct keys) before the
        # first shuffle join; after each large join, aggregate again so the key
        # just resolved leaves the grain and the next shuffle carries fewer rows.
        # Filtered dimensions go first (they drop the most), then smaller ones.
        # A dimension bucketed with the fact goes first: the pre-aggregation and
        # that join then reuse the bucketing instead of shuffling.
        order = sorted(large, key=lambda d: (d != self.colocated, d not in filters,
                                             self.bounds.get(d) or float("inf")))
        large_keys = [DIMENSIONS[d][1] for d in order]
        out_names = [a.out for a in out_attrs]
        if count_trx:
            key_parts = []
        fact_side_keys = [k for k in key_parts if k in fact_cols or k in small_outs]
        grain = list(dict.fromkeys(small_outs + large_keys + fact_side_keys + ["__copy"] * bool(copies)))
        merge = {SUM: F.sum, MIN: F.min, MAX: F.max}
        partial: dict[str, str] = {}                     # alias -> kind, present in g
        late: dict[str, list[tuple[str, str, str]]] = {}  # dim -> (alias, column, kind)
        aggs = []
        dim_of_out = {o: d for d in large for o in need[d].values()}
        for p in parts:
            if p.kind == KEY:
                continue
            src = self.resolve(p.source).out if p.source and p.source not in fact_cols else p.source
            if src in dim_of_out:
                # an attribute of a large dimension depends only on its key, which
                # is in the grain: it becomes a partial once that dimension is joined
                if p.kind == SUM:
                    raise ValueError(f"cannot pre-aggregate SUM over dimension attribute {p.source}")
                late.setdefault(dim_of_out[src], []).append((p.alias, src, p.kind))
                continue
            aggs.append(merge[p.kind](line_parts[p.alias]).alias(p.alias))
            partial[p.alias] = p.kind
        if count_trx:
            aggs.append(F.count_distinct("transaction_id").alias(TRX_COUNT))
            partial[TRX_COUNT] = SUM
        if not aggs:
            aggs, partial = [F.count(F.lit(1)).alias("__rows")], {"__rows": SUM}
        if "transaction_id" in grain:
            # at the grain of the transaction's lines there is next to nothing to
            # sum up: that shuffle would carry the rows once more
            g = f.select(*grain, *[F.lit(1).cast("long").alias(a) if a == "__rows" else line_parts[a].alias(a) for a in partial])
        else:
            g = f.groupBy(*grain).agg(*aggs)
        for i, d in enumerate(order):
            key = DIMENSIONS[d][1]
            g = g.join(dim_side(d), key, "inner")
            for alias, src, kind in late.get(d, []):
                g = g.withColumn(alias, F.col(src))
                partial[alias] = kind
            keep_key = key in out_names or key in key_parts
            grain = [c for c in grain if c != key or keep_key]
            grain += [o for o in need[d].values() if o not in grain]
            if i < len(order) - 1 and "transaction_id" not in grain:
                g = g.groupBy(*grain).agg(*[merge[k](F.col(a)).alias(a) for a, k in partial.items()])
        cols = list(dict.fromkeys(out_names + key_parts))
        return g.select(*cols, *line_parts.keys(), *[TRX_COUNT] * count_trx, *["__copy"] * bool(copies))

    # ------------------------------------------------------------ aggregate
    def aggregate(self, by: Iterable[str], measures: Iterable[str], where: Mapping | None = None,
                  force: str | None = None) -> DataFrame:
        """GROUP BY ``by`` with the named measures (plain star query)."""
        by = list(by)
        ms = [measure(m, self.approx_distinct) for m in measures]
        base, ms = self.counted_base(by, ms, where, force)
        outs = [self.resolve(a).out for a in by]
        aggs = [m.agg() for m in ms]
        return base.groupBy(*outs).agg(*aggs) if outs else base.agg(*aggs)
