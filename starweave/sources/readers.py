"""Source readers.  Parquet by default, JDBC with the same interface;
filters and projections are left to Catalyst, which pushes them into the
scan (parquet ``PushedFilters``/``ReadSchema``, JDBC WHERE clause).

A JDBC table is read by several queries at once: by ranges of a number
(Spark's own option) or, for dates and strings, by a list of predicates, one
query each.  Every row, also one with NULL there, fits exactly one predicate."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SOURCE_SCHEMAS


def conform(df: DataFrame, schema: T.StructType | str, name: str = "table") -> DataFrame:
    """The declared columns of ``df`` in their declared order and types; other
    columns go.  A declared column that is missing raises; under ANSI mode a
    value that does not fit its type raises too when it is read."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name} has no column {', '.join(missing)}")
    return df.select(*[F.col(f.name) if df.schema[f.name].dataType == f.dataType
                       else F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """The table at ``path``.  Formats without types of their own are parsed
    with ``schema``; the others are read as they are and conformed to it."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is None:
        return r.load(path)
    if fmt in ("csv", "json", "text"):
        return r.schema(schema).load(path)
    return conform(r.load(path), schema, path)


# ---------------------------------------------------------------- JDBC
def _quoted(v) -> str:
    return f"DATE '{v}'" if isinstance(v, date) else "'" + str(v).replace("'", "''") + "'"


def range_slices(column: str, bounds: Sequence) -> list[str]:
    """Predicates that cut the values of ``column`` (dates or strings) at
    ``bounds``: below the first, from one to the next, from the last on.  NULL
    belongs to the first."""
    cuts = sorted(set(bounds))
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {_quoted(cuts[0])} OR {column} IS NULL"
    middle = [f"{column} >= {_quoted(a)} AND {column} < {_quoted(z)}" for a, z in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= {_quoted(cuts[-1])}"]


def date_slices(column: str, first: date, last: date, n: int) -> list[str]:
    """At most ``n`` slices of about equal length between two days; rows
    outside them are in the first and the last slice."""
    days = (last - first).days + 1
    n = max(1, min(n, days))
    return range_slices(column, [first + timedelta(days=days * i // n) for i in range(1, n)])


def hash_slices(column: str, n: int, number: str = "CRC32({column})") -> list[str]:
    """``n`` slices by a hash of ``column``, for keys without known bounds.
    ``number`` is the database's expression of a whole number >= 0."""
    of = f"MOD(COALESCE({number.format(column=column)}, 0), {n})"
    return [f"{of} = {i}" for i in range(n)]


@dataclass(frozen=True)
class JdbcRead:
    """A JDBC read of one table: connection options, and either a numeric
    partition column among them or one predicate a query."""
    options: Mapping[str, str]
    predicates: Sequence[str] = field(default=())

    def load(self, spark: SparkSession) -> DataFrame:
        if not self.predicates:
            return spark.read.format("jdbc").options(**self.options).load()
        rest = {k: v for k, v in self.options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(self.options["url"], self.options["dbtable"], predicates=list(self.predicates), properties=rest)


def jdbc_read(url: str | None, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower=None, upper=None, num_partitions: int | None = None,
              fetchsize: int = 10_000, predicates: Sequence[str] = ()) -> JdbcRead:
    """Options of a read; what cannot be read in one piece raises here."""
    if not url:
        raise ValueError(f"a JDBC read of {table} needs the option url")
    opts = {"fetchsize": str(fetchsize), **(properties or {}), "url": url, "dbtable": table}
    if partition_column and predicates:
        raise ValueError("a partition column or predicates, not both")
    if partition_column:
        if lower is None or upper is None:
            raise ValueError(f"partition column {partition_column} needs its bounds")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions or 8))
    return JdbcRead(opts, tuple(predicates))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10_000, predicates: Sequence[str] = ()) -> DataFrame:
    """A partitioned JDBC read: range queries on a numeric column, or one query
    a predicate, instead of one single-connection scan."""
    return jdbc_read(url, table, properties, partition_column, lower, upper, num_partitions, fetchsize,
                     predicates).load(spark)


def read_sources(spark: SparkSession, root: str = "", fmt: str = "parquet", tables=tuple(SOURCE_SCHEMAS),
                 options: Mapping[str, str] | None = None,
                 slices: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """The raw retail tables, in their declared columns and types: files
    ``{root}/{table}`` of any format, or with ``fmt="jdbc"`` the tables of the
    database in ``options`` (url, user, ...), ``root`` before their names where
    it is a schema.  ``slices`` are predicates by table."""
    out = {}
    for t in tables:
        if fmt == "jdbc":
            rest = {k: v for k, v in (options or {}).items() if k != "url"}
            plan = jdbc_read((options or {}).get("url"), f"{root}.{t}" if root else t, rest,
                             predicates=(slices or {}).get(t, ()))
            out[t] = conform(plan.load(spark), SOURCE_SCHEMAS[t], t)
            continue
        ext = f".{fmt}" if fmt in ("parquet", "csv", "json", "orc") else ""
        opts = {**({"header": "true"} if fmt == "csv" else {}), **(options or {})}
        out[t] = read_table(spark, f"{root.rstrip('/')}/{t}{ext}", fmt, SOURCE_SCHEMAS[t], opts)
    return out


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                fmt: str = "parquet", jdbc: Mapping[str, str] | None = None) -> None:
    """S8/S9 sink: overwrite (full refresh) or append; JDBC in 1,000-row batches."""
    if fmt == "jdbc":
        (df.write.format("jdbc").options(batchsize="1000", **(jdbc or {}))
           .option("dbtable", path).mode(mode).save())
        return
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
