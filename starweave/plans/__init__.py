"""The star schema, its builders, the query catalogue and summaries."""
