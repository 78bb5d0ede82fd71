"""The engine's queries by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threshline.plans import dialogue_queries, entry_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**entry_queries.QUERIES, **dialogue_queries.QUERIES}
ORACLES: dict[str, str] = {**entry_queries.ORACLES, **dialogue_queries.ORACLES}
#: Filter, buckets, distinct counts, left joins and a total in one report.
FLAGSHIP = "report_contributions"
