"""Every catalogue query against its independent DuckDB statement (sf0.001)."""

import math

import pytest

import __spark_entry__ as E
from starweave.plans.catalogue import CATALOGUE, TESTDATA
from starweave.plans.load_checks import LOADS
from starweave.plans.stock_checks import STOCK
from starweave.plans.two_loads import TWO_LOADS

TABLE_QUERIES = LOADS | STOCK
NAMES = sorted(CATALOGUE) + sorted(TABLE_QUERIES)
SMALL = "/root/testdata/sf0.001"


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(x, 9) if isinstance(x, float) and not math.isnan(x) else
                         (str(x) if hasattr(x, "isoformat") else x) for x in r))
    return sorted(out, key=lambda r: [str(x) for x in r])


SPARK_TO_SQL = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(name, spark, tpch_star, duck):
    sdf = TABLE_QUERIES[name](spark, SMALL) if name in TABLE_QUERIES else CATALOGUE[name](tpch_star, TESTDATA)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    sql_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in sdf.schema.fields:
        assert SPARK_TO_SQL.get(f.dataType.simpleString()) == sql_types[f.name], f.name
    idx = [rel.columns.index(c) for c in sdf.columns]
    drows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm([tuple(r) for r in sdf.collect()]) == _norm(drows)


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    optional = set(E.LLM_QUERIES) | {"pipeline"}
    assert set(E.queries()) - optional == set(E.oracle_sql()) - optional == {*CATALOGUE, *LOADS, *TWO_LOADS, *STOCK}


def test_star_that_cannot_be_written_raises(spark, monkeypatch):
    def fail(*_):
        raise OSError("no shared folder")

    monkeypatch.setattr(E, "materialize", fail)
    monkeypatch.setattr(E, "_STARS", {})
    with pytest.raises(OSError):
        E.star_for(spark, "/root/testdata/sf0.001")


def test_lazy_star_fallback_gives_same_answers(spark, tpch_star):
    from starweave.sources.tpch import star_from_tpch
    lazy = star_from_tpch(spark, "/root/testdata/sf0.001")
    for name in ("monthly_recap", "rollup_geo", "store_rank_month"):
        a = sorted(map(tuple, CATALOGUE[name](lazy, TESTDATA).collect()), key=repr)
        b = sorted(map(tuple, CATALOGUE[name](tpch_star, TESTDATA).collect()), key=repr)
        assert a == b, name
