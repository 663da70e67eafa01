import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starweave.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, app="starweave-tests")
    yield s


@pytest.fixture(scope="session")
def tpch_star(spark):
    import __spark_entry__ as E
    return E.star_for(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def retail(spark):
    from tests.retail_fixture import retail_sources
    return retail_sources(spark, clean=True)


@pytest.fixture(scope="session")
def retail_dirty(spark):
    from tests.retail_fixture import retail_sources
    return retail_sources(spark, clean=False)
