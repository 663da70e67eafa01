"""starweave: a Spark-native retail star schema and OLAP operator library.

Layers:
  sources    readers for the raw retail tables and the TPC-H-style test tables
  functions  Column factories: calendar attributes, measures, labels, keys
  plans      the star itself (dimensions + fact), the ETL that builds it,
             the query catalogue and the pre-aggregated summaries
  operators  OLAP operators (drill/roll/slice/dice/pivot/cube/grouping sets),
             period analysis (moving average, growth, YTD, rank, share),
             data-quality audits and the SCD2 merge
  streaming  file-arrival trigger for the star refresh
"""

__version__ = "0.1.0"

from .plans.catalogue import CATALOGUE, RETAIL, TESTDATA, CatalogueParams  # noqa: E402
from .plans.etl import build_star, load_warehouse  # noqa: E402
from .plans.materialize import materialize, read_star, read_star_tables, write_star, write_star_tables  # noqa: E402
from .plans.star import Star  # noqa: E402
from .plans.summaries import publish_summaries, refresh_summaries  # noqa: E402
from .sources.readers import read_sources  # noqa: E402
from .sources.tpch import star_from_tpch  # noqa: E402

__all__ = ["CATALOGUE", "RETAIL", "TESTDATA", "CatalogueParams", "Star", "build_star", "load_warehouse",
           "materialize", "read_star", "read_star_tables", "write_star", "write_star_tables",
           "refresh_summaries", "publish_summaries", "read_sources", "star_from_tpch"]
